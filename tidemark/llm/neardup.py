"""Near-duplicate documents by MinHash bands, verified with odd sketches and then exactly.

Sets are the distinct word shingles of a text. Documents of equal sets are one class. Each class has
`BANDS` x `ROWS` MinHash values. Equal bands make buckets; the values folded into a bitmap by parity
make its odd sketch, in which two sets differ in about as many bits as their samples do, so the XOR's
population count tells high similarities apart. A second parity bitmap of the whole set never shows more
differing bits than the sets differ in elements, so it rules pairs out for certain; it is sharp for sets up
to some hundreds of shingles, the sketch for larger ones. Pairs that the sketches leave are compared on whole
sets, so no false link is made. A true link can be missed: at the threshold a pair misses all bands with
probability 1e-7; the odd sketch rejects it with some 1e-9 (`SLACK`, 6 deviations of a normal estimate; computed).

Buckets are not expanded into pairs. First every member is compared with one center of the bucket, the
class whose bands are shared most: copies that were edited each in their own way are all nearest to
the text they came from. That links most groups of copies. Then only buckets that still hold several
components are looked at. Members outside the largest component of the bucket are compared with
all of it by size and bitmaps, in blocks of bounded size, in Python, and of the pairs that pass only the closest few
of each such member leave the task, to be compared exactly; components that get linked need no further
pairs, and the number grows from round to round until none was held back, so this loses no further link. Components come by repeated smallest-neighbour steps with
pointer jumps; each step is fixed in the shared folder. Nothing of it goes through the driver.

Null or empty text, or text without words: an empty set, linked with nothing. Rows of equal id are one
document; a row without an id stands alone, without a component, and is kept. Extra columns are left
behind. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.session import pin, setting

SHINGLE = 5
THRESHOLD = 80
BANDS = 40
ROWS = 5
SKETCH_LONGS = 8
#: Bitmap of the whole set.
PARITY_LONGS = 16
#: Deviations of the sketch's estimate below the threshold at which a pair is still compared.
SLACK = 6.0
BLOCK = 512
#: Rows that go to Python at a time: a batch is held by the JVM, by Arrow and as Python objects at once.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
#: Closest members of other components that a member is compared with in the first round; then ever more.
CLOSEST = 16
#: Factor of that number from round to round.
GROWTH = 64

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_hash", pa.binary()),
        ("bands", pa.list_(pa.int64())),
        ("sketch", pa.list_(pa.int64())),
        ("parity", pa.list_(pa.int64())),
    ]
)


def folded(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).decode("utf-8", "surrogatepass")


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of the whole sequence if it is shorter than one."""
    words = common.word_hashes(folded(text) if text else None)
    return np.unique(common.rolling(words, min(width, len(words)))) if len(words) else words


def odd_bits(values: np.ndarray, longs: int) -> np.ndarray:
    """A bitmap in which each value flips the bit it hashes to."""
    bits = common.mixed(values) % np.uint64(64 * longs)
    odd = (np.bincount(bits.astype(np.int64), minlength=64 * longs) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


class Signer:
    """MinHash values by multiply-add hashes of fixed seeds."""

    def __init__(self, bands: int, rows: int) -> None:
        seeds = np.random.default_rng(20240131)
        n = bands * rows
        self.a = seeds.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = seeds.integers(0, 1 << 63, n, dtype=np.uint64)
        self.place = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.bands, self.rows = bands, rows

    def values(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), common.MASK, np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[None, at : at + 2048] * self.a[:, None]
            part += self.b[:, None]
            np.minimum(least, part.min(axis=1), out=least)
        return least

    def band_keys(self, values: np.ndarray) -> np.ndarray:
        keys = np.arange(self.bands, dtype=np.uint64)
        for row in values.reshape(self.bands, self.rows).T:
            keys = common.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
        return keys.view(np.int64)

    def sketch(self, values: np.ndarray) -> np.ndarray:
        """The parity bitmap: each value flips the bit it hashes to."""
        return odd_bits(values + self.place, SKETCH_LONGS)


def most_bits(threshold: int, samples: int) -> int:
    """Bits in which the sketches of sets at the threshold may differ, with the slack."""
    share, size = threshold / 100, 64 * SKETCH_LONGS
    differing = samples * (1 - share)
    flat = np.exp(-4 * differing / size)
    from_values = 2 * flat * np.sqrt(samples * share * (1 - share))
    from_bits = 2 * np.sqrt(2 * differing**2 / size)  # two values on one bit undo each other
    return int(np.ceil(size / 2 * (1 - flat) + SLACK * np.hypot(from_values, from_bits)))


def signed(rows: DataFrame, width: int, bands: int, band_rows: int) -> DataFrame:
    def sign(batch: pa.RecordBatch) -> dict:
        signer = common.cached(("signer", bands, band_rows), lambda: Signer(bands, band_rows))
        out: dict[str, list] = {f.name: [] for f in SIGNED}
        out["doc_id"] = batch.column("doc_id").to_pylist()
        for text in batch.column("text").to_pylist():
            shingles = shingle_set(text, width)
            out["n_shingles"].append(len(shingles))
            out["set_hash"].append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            if len(shingles):
                values = signer.values(shingles)
                out["bands"].append(signer.band_keys(values))
                out["sketch"].append(signer.sketch(values))
                out["parity"].append(odd_bits(shingles, PARITY_LONGS))
            else:
                out["bands"].append([])
                out["sketch"].append([])
                out["parity"].append([])
        return out

    return rows.mapInArrow(
        common.per_batch(sign, SIGNED),
        "doc_id long, n_shingles long, set_hash binary, bands array<long>, sketch array<long>, parity array<long>",
    )


def differing(a: str, b: str, longs: int) -> Column:
    """Bits in which two bitmaps differ."""
    one, two = F.col(a), F.col(b)
    return sum(F.bit_count(F.get(one, i).bitwiseXOR(F.get(two, i))) for i in range(longs))


def bits_apart(many: np.ndarray, one: list[int]) -> np.ndarray:
    return np.bitwise_count(many ^ np.array(one, np.int64).view(np.uint64)).sum(axis=1).astype(np.int64)


def verified(pairs: DataFrame, rows: DataFrame, width: int, threshold: int, block: int) -> DataFrame:
    """The pairs whose whole sets are similar enough, as (a, b) with a below b.

    `pairs` are of a center and a doc_id. A center's set meets those of its partners in groups of about `block`, so
    each partner's set is shuffled once for each of its pairs, and a center's once for each group. Texts
    without a pair are left where they are.
    """
    pairs = pin(pairs)
    many = pairs.groupBy("center").agg(F.expr(f"cast(ceil(count(1) / {block}) as int)").alias("groups"))
    place = F.pmod(F.xxhash64("doc_id"), F.col("groups")).cast("int").alias("i")
    partners = pairs.join(many, "center").select("doc_id", "center", place, F.lit(False).alias("is_center"))
    every = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("i")
    centers = many.select(F.col("center").alias("doc_id"), "center", every, F.lit(True).alias("is_center"))
    roles = common.size_checked(partners.union(centers))

    def to_sets(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, width).tobytes() for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id").to_pylist(), "shingles": sets}

    def compared(table: pa.Table) -> pa.Table:
        found: set[tuple[int, int]] = set()
        is_center = table.column("is_center").to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        ids = table.column("doc_id").to_pylist()
        for k in (k for k, c in enumerate(is_center) if c):
            for j in (j for j, c in enumerate(is_center) if not c):
                common_ones = len(np.intersect1d(sets[k], sets[j], assume_unique=True))
                if 100 * common_ones >= threshold * (len(sets[k]) + len(sets[j]) - common_ones):
                    found.add((min(ids[k], ids[j]), max(ids[k], ids[j])))
        return pa.Table.from_pydict({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=PAIR)

    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])
    wanted = common.size_checked(roles.select("doc_id").distinct())
    sets = rows.join(wanted, "doc_id", "left_semi").mapInArrow(
        common.per_batch(to_sets, schema), "doc_id long, shingles binary"
    )
    met = sets.join(roles, "doc_id").groupBy("center", "i").applyInArrow(compared, "a long, b long")
    return met.distinct()


def labels_of(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of the edges reaches."""
    both = pin(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "next").distinct())
    labels = pin(both.groupBy("node").agg(F.min("next").alias("n")).select("node", F.least("node", "n").alias("label")))
    while True:
        theirs = labels.select(F.col("node").alias("next"), F.col("label").alias("theirs"))
        reached = both.join(theirs, "next").groupBy("node").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(reached, "node").select("node", "label", F.least("label", "theirs").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("far"))
        step = pin(nearer.join(jump, "to", "left").select("node", "label", F.least("to", F.coalesce("far", "to")).alias("new")))
        changed = step.filter("new < label").limit(1).count()
        labels = step.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def with_links(labels: DataFrame, edges: DataFrame, classes: DataFrame) -> DataFrame:
    """The labels after more links: only the components that the new links touch are joined anew."""
    # Rows of one id and several texts are several classes, but one node.
    nodes = classes.select(F.col("doc_id").alias("node")).distinct().join(labels, "node", "left")
    named = nodes.select("node", F.coalesce("label", "node").alias("label"))
    of_a = named.select(F.col("node").alias("a"), F.col("label").alias("p"))
    of_b = named.select(F.col("node").alias("b"), F.col("label").alias("q"))
    between = edges.join(of_a, "a").join(of_b, "b").filter("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b"))
    moved = labels_of(between.distinct()).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return pin(named.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")))


def left_over(
    members: DataFrame, labels: DataFrame, classes: DataFrame, most: int, threshold: int, block: int, closest: int
) -> DataFrame:
    """Pairs within buckets that still hold several components, whose sketches are close enough.

    members: key, doc_id, center, n. Of two members in different components one is outside the bucket's
    largest component; those outside ask, and all members answer. Askers and members are dealt to
    blocks, and each pair of blocks is one small group of rows. Of each asker and block the `closest`
    partners are given; a row of nulls says that some were held back.
    """
    placed = members.filter("n > 2").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    named = pin(placed.withColumn("label", F.coalesce("label", "doc_id")))  # used twice
    parts = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = F.max(F.struct("size", (-F.col("label")).alias("minus")))
    unsettled = (
        parts.groupBy("key")
        .agg(largest.alias("top"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select("key", (-F.col("top.minus")).alias("main"), F.col("top.size").alias("main_n"))
    )
    asks = F.col("label") != F.col("main")
    place = F.xxhash64("doc_id")
    open_rows = (
        named.join(unsettled, "key")
        .withColumn("ask_blocks", F.expr(f"cast(ceil((n - main_n) / {block}) as int)"))
        .withColumn("blocks", F.expr(f"cast(ceil(n / {block}) as int)"))
        .withColumn("i", F.pmod(place, F.col("ask_blocks")).cast("int"))
        .withColumn("j", F.pmod(place, F.col("blocks")).cast("int"))
    )
    answer = F.transform(
        F.sequence(F.lit(0), F.col("ask_blocks") - 1), lambda i: F.struct(i.alias("i"), F.col("j"), F.lit(False).alias("asks"))
    )
    ask = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.col("i"), j.alias("j"), F.lit(True).alias("asks"))
    )
    sent = F.concat(answer, F.when(asks, ask).otherwise(F.slice(ask, 1, 0)))
    dealt = (
        open_rows.select("key", "doc_id", "label", "center", F.inline(sent))
        .join(classes.select("doc_id", "n_shingles", "sketch", "parity"), "doc_id")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )

    def pairs_of(rows: list[dict]) -> Iterator[tuple[int | None, int | None]]:
        answers = [r for r in rows if not r["asks"]]
        if not answers:
            return
        ids, labels_ = np.array([r["doc_id"] for r in answers]), np.array([r["label"] for r in answers])
        sizes = np.array([r["n_shingles"] for r in answers])
        sketches = np.array([r["sketch"] for r in answers], np.int64).view(np.uint64)
        parities = np.array([r["parity"] for r in answers], np.int64).view(np.uint64)
        for r in rows:
            if not r["asks"] or r["doc_id"] == r["center"]:
                continue
            size = r["n_shingles"]
            near = (labels_ != r["label"]) & (ids != r["center"])
            near &= 100 * np.minimum(sizes, size) >= threshold * np.maximum(sizes, size)
            at = np.flatnonzero(near)
            least = bits_apart(parities[at], r["parity"])
            at = at[(100 + threshold) * least <= (100 - threshold) * (sizes[at] + size)]
            far = bits_apart(sketches[at], r["sketch"])
            at, far = at[far <= most], far[far <= most]
            at = at[np.argsort(far, kind="stable")]
            for other in ids[at[:closest]].tolist():
                yield min(r["doc_id"], other), max(r["doc_id"], other)
            if len(at) > closest:
                yield None, None

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        found: set[tuple] = set()

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=PAIR)
            found.clear()
            return made

        for batch in batches:
            for row in batch.to_pylist():
                if group and (row["key"], row["i"], row["j"]) != (group[0]["key"], group[0]["i"], group[0]["j"]):
                    found.update(pairs_of(group))
                    group = []
                    if len(found) > 20_000:
                        yield flushed()
                group.append(row)
        if group:
            found.update(pairs_of(group))
        yield flushed()
        common.give_back()

    return dealt.mapInArrow(search, "a long, b long").distinct()


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    threshold: int = THRESHOLD,
    bands: int = BANDS,
    band_rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    with setting(docs.sparkSession, BATCH):
        return components_of(common.documents(docs, id_col, text_col), width, threshold, bands, band_rows, block)


def components_of(rows: DataFrame, width: int, threshold: int, bands: int, band_rows: int, block: int) -> DataFrame:
    scratch = common.Scratch(rows.sparkSession)
    own = scratch.keep(signed(rows, width, bands, band_rows))
    most = most_bits(threshold, bands * band_rows)
    named = own.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = scratch.keep(
        named.groupBy("set_hash").agg(
            F.min("doc_id").alias("doc_id"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("bands").alias("bands"),
            F.any_value("sketch").alias("sketch"),
            F.any_value("parity").alias("parity"),
        )
    )
    buckets = classes.select("doc_id", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = scratch.keep(buckets.join(sizes, "key"))
    rank = shared.groupBy("doc_id").agg(F.sum("n").alias("shared"))
    centers = (
        shared.select("key", "doc_id")
        .join(rank, "doc_id")
        .groupBy("key")
        .agg(F.max(F.struct("shared", (-F.col("doc_id")).alias("minus"))).alias("top"))
        .select("key", (-F.col("top.minus")).alias("center"))
    )
    members = scratch.keep(shared.join(centers, "key"))
    star = members.filter("doc_id <> center").select(F.least("center", "doc_id").alias("a"), F.greatest("center", "doc_id").alias("b")).distinct()
    mine = ["doc_id", "n_shingles", "sketch", "parity"]
    side_a = classes.select(*mine).toDF("a", "m", "s", "p")
    side_b = classes.select(*mine).toDF("b", "n", "t", "q")
    sized = 100 * F.least("m", "n") >= threshold * F.greatest("m", "n")
    bound = (100 + threshold) * differing("p", "q", PARITY_LONGS) <= (100 - threshold) * (F.col("m") + F.col("n"))
    likely = differing("s", "t", SKETCH_LONGS) <= most
    close = pin(star.join(side_b, "b").join(side_a, "a").filter(sized & bound & likely).select("a", "b"))
    texts = rows.filter(F.col("doc_id").isNotNull())
    # A center is one for many members: the pair is turned so that its set meets theirs.
    turned = close.join(centers.select(F.col("center").alias("a")).distinct().withColumn("_top", F.lit(True)), "a", "left")
    center = F.when(F.col("_top"), F.col("a")).otherwise(F.col("b"))
    turned = turned.select(center.alias("center"), F.when(F.col("_top"), F.col("b")).otherwise(F.col("a")).alias("doc_id"))
    labels = labels_of(verified(turned, texts, width, threshold, block))
    tested = close
    closest = CLOSEST
    while True:
        found = pin(left_over(members, labels, classes, most, threshold, block, closest))
        new = pin(found.filter("a is not null").join(tested, ["a", "b"], "left_anti"))
        if new.limit(1).count():
            asked = new.toDF("center", "doc_id")
            labels = with_links(labels, verified(asked, texts, width, threshold, block), classes)
            tested = tested.union(new)
        if not found.filter("a is null").limit(1).count():
            break
        closest *= GROWTH
    of_set = classes.select("set_hash", F.col("doc_id").alias("node")).join(labels, "node", "left")
    of_set = of_set.select("set_hash", F.coalesce("label", "node").alias("component_id"))
    placed = own.select("doc_id", "n_shingles", "set_hash").join(of_set, "set_hash", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    found = pin(
        placed.select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )
    scratch.clear()
    return found


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, one of each component, with all their columns; of equal ids one row.

    Rows are counted by id on the ids alone, so that only rows whose id comes again are shuffled and
    ordered with their texts.
    """
    found = near_duplicates(docs, **options).filter(F.col("doc_id").isNotNull())
    ids = found.groupBy(F.col("doc_id").alias("_kept")).agg(F.bool_or("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    ids = pin(ids.filter("stays").select("_kept", "n"))
    single = common.size_checked(ids.filter("n = 1").select("_kept"))
    alone = docs.join(single, docs["doc_id"] == single["_kept"], "left_semi")
    stays = alone.unionByName(docs.filter(F.col("doc_id").isNull()))
    if ids.filter("n > 1").isEmpty():
        return stays
    several = common.size_checked(ids.filter("n > 1").select("_kept"))
    again = docs.join(several, docs["doc_id"] == several["_kept"], "left_semi")
    # Of rows with one id the same one stays whenever a task runs again.
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    first = again.withColumn("_row_of_id", F.row_number().over(order)).filter("_row_of_id = 1").drop("_row_of_id")
    return stays.unionByName(first)
