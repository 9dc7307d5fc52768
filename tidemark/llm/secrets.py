r"""Secret scans with linking of credentials that come in parts.

Strong parts are reported wherever they stand: assigned passwords and tokens, access identifiers, long
hexadecimal strings. Weak parts alone say little: a short assigned secret, a user or client name, an
endpoint. They are reported only where parts complement each other within a scope of `SCOPE` code
points from start to start:

    a weak secret needs an identifier or an endpoint,
    an identifier needs a secret,
    an endpoint needs a secret and an identifier,

where strong assignments and hexadecimal strings count as secrets and access identifiers as identifiers.

Everything is DataFrame work. Parts are found in the row of the document. Linking is an interval
join on cells of the scope's length: the parts of a cell are reduced to the first and last start of
each role, and a part meets the cell before, its own and the one after. No pairs of parts are made,
so many parts in one text stay linear. Only parts of texts with weak parts are shuffled, never text.

Null text is empty. Rows are told apart by id and text: repeated rows get equal results, and rows of
equal id with other texts their own; null ids count as equal. Equal starts are ordered by kind. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.session import pin

SCOPE = 400
MASKED = "[secret]"

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind: pattern, the group whose length counts, least and most characters of it.
STRONG = {
    "assign": (ASSIGN, 2, 12, None),
    "access": (r"AKIA[A-Z0-9]+", 0, 18, None),
    "hex": (r"[0-9a-f]+", 0, 16, None),
}
WEAK = {
    "weak_secret": (ASSIGN, 2, 6, 11),
    "identifier": (
        r"""(?i:\b(?:user_?(?:name|id)?|login|client_?id|account_?(?:id|name)?))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9_.@-]+)""",
        1,
        3,
        64,
    ),
    "endpoint": (r"""(?i:\b(?:https?|ftp|ssh|jdbc:[a-z]{2,12}|postgres|mysql|mongodb|redis|amqp)://)[A-Za-z0-9._:/@-]+""", 0, 10, None),
}
KINDS = [*STRONG, *WEAK]
ROLE = {
    "assign": "secret",
    "hex": "secret",
    "weak_secret": "secret",
    "access": "identifier",
    "identifier": "identifier",
    "endpoint": "endpoint",
}
ROLES = ("secret", "identifier", "endpoint")
SPAN = "array<struct<start: bigint, no: int, end: bigint>>"


def spans(text: Column, kind: str) -> Column:
    """The matches of a kind that are long enough, as (start, number of the kind, end)."""
    pattern, group, least, most = (STRONG | WEAK)[kind]
    # A shorter pattern for runs of one class: a run that is too short holds no match that is long enough.
    if kind == "hex":
        pattern = rf"[0-9a-f]{{{least},}}"
    if kind == "access":
        pattern = rf"AKIA[A-Z0-9]{{{least - 4},}}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    number = KINDS.index(kind) + 1

    def step(at: Column, m: Column) -> tuple[Column, Column]:
        start = at + F.length(m["before"])
        end = start + F.length(m["whole"])
        size = F.length(m["part"])
        good = (size >= least) & (size <= most) if most else size >= least
        one = F.array(F.struct(start.alias("start"), F.lit(number).alias("no"), end.alias("end")))
        return end, F.when(good, one).otherwise(F.array().cast(SPAN))

    zipped = F.arrays_zip(
        F.slice(between, 1, F.size(found)).alias("before"), found.alias("whole"), measured.alias("part")
    )
    walked = common.bound(zipped, lambda z: common.walked(z, step, SPAN))
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(SPAN))


def parts(docs: DataFrame) -> DataFrame:
    """`docs` with `_base` and `_weak`: the strong and the weak parts of `text`, in order."""
    body = F.coalesce(F.col("text"), F.lit(""))
    found = docs.withColumns({f"_{kind}": spans(body, kind) for kind in KINDS})
    return found.select(
        *docs.columns,
        F.array_sort(F.concat(*(F.col(f"_{k}") for k in STRONG))).alias("_base"),
        F.array_sort(F.concat(*(F.col(f"_{k}") for k in WEAK))).alias("_weak"),
    )


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, text_hash and `_linked`: the weak parts that others complement; texts without any have no row."""
    key = ["doc_id", "text_hash"]
    each = (
        found.filter(F.size("_weak") > 0)
        .select(*key, F.explode(F.concat("_base", "_weak")).alias("p"))
        .select(*key, "p.*")
        .distinct()
        .withColumn("cell", F.expr(f"start div {scope}"))
    )
    role = F.element_at(F.array(*(F.lit(ROLE[k]) for k in KINDS)), F.col("no"))
    each = each.withColumn("role", role)
    cells = each.groupBy(*key, "cell").agg(
        *(
            function(F.when(F.col("role") == r, F.col("start"))).alias(f"{end}_{r}")
            for r in ROLES
            for end, function in (("first", F.min), ("last", F.max))
        )
    )
    weak = each.filter(F.col("no") > len(STRONG))
    asked = weak.withColumn("cell", F.explode(F.array(*(F.col("cell") + k for k in (-1, 0, 1)))))

    def near(r: str) -> Column:
        """The cell holds a part of the role within the scope; of a part's own cell all are."""
        first, last = F.col(f"first_{r}"), F.col(f"last_{r}")
        inside = (first >= F.col("start") - scope) & (first <= F.col("start") + scope)
        return F.coalesce(inside | ((last >= F.col("start") - scope) & (last <= F.col("start") + scope)), F.lit(False))

    cells = cells.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "cell": "_cell"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")) & (F.col("cell") == F.col("_cell"))
    met = asked.join(cells, same).groupBy(*key, "start", "no", "end", "role").agg(
        *(F.max(near(r)).alias(f"has_{r}") for r in ROLES)
    )
    complemented = (
        F.when(F.col("role") == "secret", F.col("has_identifier") | F.col("has_endpoint"))
        .when(F.col("role") == "identifier", F.col("has_secret"))
        .otherwise(F.col("has_secret") & F.col("has_identifier"))
    )
    return (
        met.filter(complemented)
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("start", "no", "end"))).alias("_linked"))
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: `base` and `spans`, arrays of (start, no, end); `no` counts KINDS from 1."""
    rows = common.documents(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    found = pin(parts(rows).drop("text"))
    more = linked(found, scope).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return found.join(more, same, "left").select(
        "doc_id",
        F.col("_base").alias("base"),
        F.array_sort(F.concat("_base", F.coalesce("_linked", F.array().cast(SPAN)))).alias("spans"),
    )


def listed(found: Column) -> Column:
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.element_at(name, s["no"]), s["start"], s["end"])), ","
    )


def digests(scanned: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        number = KINDS.index(kind) + 1
        return F.size(F.filter("base", lambda s: s["no"] == number)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id",
        *(count(k) for k in STRONG),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def masked(text: Column, found: Column, mark: str = MASKED) -> Column:
    """The text with each stretch of spans, ordered by start, replaced by the mark."""
    cut = "array<struct<start: bigint, end: bigint>>"

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        before = F.array(F.struct(at.alias("start"), s["start"].alias("end")))
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, before).otherwise(F.array().cast(cut))

    end = F.array_max(F.transform(found, lambda s: s["end"]))
    tail = F.struct(F.coalesce(end, F.lit(0).cast("long")).alias("start"), F.length(text).cast("long").alias("end"))
    return F.array_join(common.cut_out(text, F.concat(common.walked(found, step, cut), F.array(tail))), mark)


def mask_secrets(docs: DataFrame, scope: int = SCOPE, mark: str = MASKED) -> DataFrame:
    """All documents with their columns; spans replaced in `text`, and `n_chars` brought in line.

    Texts are scanned twice rather than shuffled; the linked parts, few as they are, are joined.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col("doc_id"),
        F.col("text"),
        F.xxhash64("text").alias("text_hash"),
    )
    more = linked(parts(rows.drop("_row")).drop("text"), scope)
    more = common.size_checked(
        more.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.to_json("_linked").alias("_json")),
        "_json",
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    both = parts(rows).join(more, same, "left").select(
        "_row",
        "text",
        F.array_sort(F.concat("_base", F.coalesce(F.from_json("_json", SPAN), F.array().cast(SPAN)))).alias("_spans"),
    )
    changed = F.when(F.size("_spans") > 0, masked(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    done = both.select("_row", changed.alias("_text"), F.size("_spans").alias("_n"))
    out = []
    for name, kind in docs.dtypes:
        old = F.col("_row")[name]
        if name == "text":
            out.append(F.col("_text").alias(name))
        elif name == "n_chars":
            out.append(F.when(F.col("_n") > 0, F.length("_text")).otherwise(old).cast(kind).alias(name))
        else:
            out.append(old.alias(name))
    return done.select(*out)
