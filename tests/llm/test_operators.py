"""Text operators against plain Python, on a given table and on rows that are hard to get right."""

from __future__ import annotations

import os
import random
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests import oracle_check as oc
from tests.llm import brute
from tidemark.llm import chat, chunks, common, decontaminate, language_model, neardup, packing, pii, quality, queries, secrets, substring

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_words long"
rng = random.Random(5)
VOCAB = [f"w{i}" for i in range(300)]
VOWELS = [a + b for a in "bcdfgklmn" for b in "ae"]
BASE = [rng.choice(VOCAB) for _ in range(120)]
SECRET = "token = abcdefabcdefabcd0123 and user: alice99 secret=shorty1 https://db.example.com/x"
HARD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n ", None, "a"),
    (4, " ".join(BASE), "en", "a"),
    (5, " ".join(BASE), "en", "a"),
    (5, " ".join(BASE), "en", "a"),
    (6, " ".join([*BASE[:60], "new", *BASE[61:]]), "de", "b"),
    (7, " ".join(rng.choice(VOCAB) for _ in range(9000)), "de", "b"),
    (8, "one", "en", "a"),
    (9, "One", "en", "a"),
    (10, SECRET + "\nmail a.b@c.de, +1 (132) 555-1352 again 555-1352 and 10.0.0.1 4970 1100 0000 0062", "en", "a"),
    (11, "\x1c a b   \U0001f600 " * 4, "xx", "c"),
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(*r, 1) for r in HARD], SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.mark.parametrize("which", ["hard", "given"])
def test_quality_counts(request, which):
    docs = request.getfixturevalue(which).drop("n_words")
    want = sorted((i, *brute.quality_counts(t).values()) for i, t in texts(docs))
    names = list(brute.quality_counts(""))
    assert sorted(tuple(r) for r in quality.judge(docs).select("doc_id", *names).collect()) == want


def test_quality_limits_follow_the_source(spark):
    plain = [(i, " ".join(rng.choice(VOCAB) for _ in range(60)), "en", "a") for i in range(150)]
    junk = [(500 + i, " ".join(rng.choice(VOCAB) + "###" for _ in range(60)), "en", "a") for i in range(20)]
    docs = spark.createDataFrame(plain + junk, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality.keep_good(docs).collect()}
    assert kept == {r[0] for r in plain}


@pytest.mark.parametrize("which", ["hard", "given"])
@pytest.mark.parametrize("chunk_chars", [2_000, 8_000_000])
def test_substring(request, which, chunk_chars):
    docs = request.getfixturevalue(which)
    got = substring.deduplicate(docs, chunk_chars=chunk_chars).collect()
    rows = texts(docs)
    want = sorted((i, " ".join(k)) for (i, _), k in zip(rows, brute.repeated_windows([t for _, t in rows])))
    assert sorted((r["doc_id"], r["kept_text"]) for r in got) == want


def test_near_duplicates(spark, given, hard):
    for docs in (given, hard.dropDuplicates()):
        rows = texts(docs)
        components, sizes = brute.components([i for i, _ in rows], [t for _, t in rows])
        found = {r["doc_id"]: r for r in neardup.near_duplicates(docs, width=2).collect()}
        for (i, _), c, n in zip(rows, components, sizes):
            assert (found[i]["component_id"], found[i]["n_shingles"], found[i]["kept"]) == (c, n, c == i)


def test_near_duplicates_of_edited_copies_in_small_blocks(spark):
    rows = []
    for i in range(80):
        words = list(BASE)
        for k in rng.sample(range(120), 9):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    components, _ = brute.components([i for i, _ in rows], [t for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, width=2, block=16).collect()}
    assert [found[i] for i in range(80)] == components


def test_rows_of_one_id_and_other_texts_are_one_document(spark, monkeypatch):
    """Links come in a later round, as the first comparison finds none; no row is lost or doubled."""
    local = random.Random(8)
    texts_ = []
    for i in range(24):
        words = list(BASE)
        for k in local.sample(range(120), 2):
            words[k] = f"y{i}_{k}"
        texts_.append((i % 12, " ".join(words)))
    docs = spark.createDataFrame(texts_ + texts_[:3], "doc_id long, text string")
    verified, calls = neardup.verified, []

    def late(pairs, *rest):
        calls.append(1)
        return verified(pairs.limit(0) if len(calls) == 1 else pairs, *rest)

    for first_round_is_empty in (False, True):
        with monkeypatch.context() as m:
            if first_round_is_empty:
                m.setattr(neardup, "verified", late)
            found = neardup.near_duplicates(docs, width=2, block=8).collect()
        # Pairs with a bucket's center are not asked for again, so without them a few texts stay alone.
        assert len(found) == len(texts_) + 3
        assert len({r["component_id"] for r in found}) <= (4 if first_round_is_empty else 1)
    assert len(calls) > 1
    kept = [neardup.keep_one(docs.repartition(n), width=2).collect() for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 1


def test_texts_of_single_ids_are_not_shuffled_to_be_kept(spark):
    other = " ".join(f"z{k}" for k in range(60))
    rows = [(1, " ".join(BASE)), (2, " ".join(BASE)), (3, other), (4, ""), (5, None)]
    kept = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Final Plan" in plan and "Window" not in plan and "Exchange hashpartitioning" not in plan

    more = [*rows, (3, other), (5, "a b c d"), (None, other), (None, other), (None, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in more], "doc_id long, text string, lang string")
    found = neardup.keep_one(docs, width=2)
    assert found.columns == docs.columns
    texts_of = sorted(((r["doc_id"] or 0, r["text"] or "") for r in found.collect()))
    assert [t for t in texts_of if t[0] != 5] == sorted([(0, other), (0, other), (0, ""), (1, " ".join(BASE)), (3, other), (4, "")])
    assert [i for i, _ in texts_of].count(5) == 1


def test_near_duplicates_take_small_batches(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    monkeypatch.setattr(neardup, "components_of", lambda *_: seen.append(spark.conf.get(key)))
    neardup.near_duplicates(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), width=2)
    assert seen == ["1000"] and spark.conf.get(key) == before


@pytest.mark.parametrize("which", ["hard", "given"])
def test_language_model_base_and_gain(request, which):
    docs = request.getfixturevalue(which)
    trained = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    split = [(i, [*brute.words(brute.low(t)), "\n"]) for i, t in texts(docs)]
    counts: dict[str, int] = {}
    for i, words in split:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (i, len(w), round(sum(np.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w), 4)) for i, w in split
    )
    got = language_model.score(docs, trained, chunk_chars=20_000).collect()
    assert sorted((r["doc_id"], r["n_tokens"], round(r["base_score"], 4)) for r in got) == want
    one = language_model.score(docs, trained).collect()
    assert sorted(round(r["score"], 3) for r in one) == sorted(round(r["score"], 3) for r in got) or which == "given"
    held = [r for r in one if not r["trained"]]
    if which == "given":
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("which", ["hard", "given"])
def test_secret_and_personal_base_spans(request, which):
    docs = request.getfixturevalue(which)
    found = secrets.digests(secrets.scan(docs)).collect()
    assert sorted((r["doc_id"], r["base_sha256"]) for r in found) == sorted(
        (i, brute.sha(",".join(brute.secret_base(t)))) for i, t in texts(docs)
    )
    personal = pii.digests(pii.scan(docs, pii.fit(docs))).collect()
    assert sorted((r["doc_id"], r["base_sha256"]) for r in personal) == sorted(
        (i, brute.sha(",".join(brute.pii_base(t)))) for i, t in texts(docs)
    )


def test_weak_parts_need_each_other(spark):
    far = " filler" * 200
    docs = spark.createDataFrame(
        [(1, SECRET), (2, "secret=shorty1"), (3, "user: alice99" + far + " secret=shorty1"), (4, "https://db.example.com/x")],
        "doc_id long, text string",
    )
    found = {r["doc_id"]: r["spans"] for r in secrets.digests(secrets.scan(docs)).collect()}
    assert all(k in found[1] for k in ("assign", "hex", "identifier", "weak_secret", "endpoint"))
    assert found[2] == found[3] == found[4] == ""
    masked = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(docs).collect()}
    assert "alice99" not in masked[1] and masked[3] == docs.filter("doc_id = 3").first()["text"]


def test_personal_scan_is_exact_on_random_texts():
    letters = "a1@.+-4 (0)"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(40))
        names = ("", "email", "ip", "card", "phone")
        assert [f"{names[k]}:{a}:{b}" for a, k, b in pii.base_spans(text)] == brute.pii_base(text)


def test_personal_spans_are_counted_by_kind(spark):
    docs = spark.createDataFrame(
        [
            (1, "1.2.3.4 and 5.6.7.8 and 9.9.9.9"),
            (2, "a@b.cd, e@f.gh, 10.0.0.1, 4111 1111 1111 1111, +49 (170) 1234567"),
            (3, "4111 1111 1111 1111"),
            (4, None),
        ],
        "doc_id long, text string",
    )
    found = pii.digests(pii.scan(docs, pii.fit(docs))).collect()
    counts = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in found}
    assert counts == {1: (0, 3, 0, 0), 2: (2, 1, 1, 1), 3: (0, 0, 1, 0), 4: (0, 0, 0, 0)}


def test_repeats_without_the_prefix_are_labelled_too(spark, given):
    docs = spark.createDataFrame([(1, "call +1 (132) 555-1352 now, or (132) 555-1352 later")], "doc_id long, text string")
    spans = pii.digests(pii.scan(docs, pii.fit(given))).first()["spans"]
    assert spans.startswith("phone:5:22") and spans.count("phone") == 2


@pytest.mark.parametrize("which", ["hard", "given"])
def test_packing_holds_every_id_once(request, which):
    docs = request.getfixturevalue(which)
    tokens = packing.tokenizer_of(packing.vocabulary_path())
    pieces = packing.pack(docs).collect()
    whole: dict = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
        whole.setdefault(p["doc_id"], []).append(p)
    lengths: dict = {}
    for p in pieces:
        lengths[p["sequence_id"]] = lengths.get(p["sequence_id"], 0) + p["length"]
    assert all(n <= 4096 and n & (n - 1) == 0 for n in lengths.values())
    for i, t in set(texts(docs)):
        want = np.array([*tokens.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        copies = sum(1 for j, _ in texts(docs) if j == i)
        assert sum(p["length"] for p in whole[i]) * 4 == copies * len(want)
        if copies == 1:
            assert b"".join(p["ids"] for p in sorted(whole[i], key=lambda p: p["start"])) == want


def test_added_tokens_in_a_text_are_those_of_the_plain_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.vocabulary_path())
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    encode = packing.word_encoder(packing.tokenizer_of(packing.vocabulary_path()), 2)
    local, letters = random.Random(3), list("aB1 '<|>\n.é中😀") + added + [a.upper() for a in added] + ["hello", "endoftext"]
    cases = ["", "hello<|endoftext|>x", *("".join(local.choices(letters, k=12)) for _ in range(2000))]
    for text, got in zip(cases, encode(cases)):
        want = [*plain.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(got, "<u4").tolist() == want, text


def test_words_are_encoded_as_by_the_plain_tokenizer_whatever_is_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 50)
    monkeypatch.setattr(packing, "TOGETHER", 7)
    monkeypatch.setattr(packing, "BLOCK_BYTES", 200)
    plain = packing.tokenizer_of(packing.vocabulary_path())
    encode = packing.word_encoder(packing.tokenizer_of(packing.vocabulary_path()), 2)
    local, parts = random.Random(4), ["abc", "Don't", "İ", "ſ", "e\u0301", "\u0301", "ñandú", "日本", "x.5", "\x1c", "\xa0", "ab<|", "ΑΣ", "<|endoftext|>"]
    words = parts + ["".join(local.choices("abcdeé", k=local.randint(1, 6))) for _ in range(300)]
    cases = ["", None, " \n", "a" * 500, *(" ".join(local.choices(words, k=12)) for _ in range(200)), ""]
    texts = pa.array(["left out", *cases]).slice(1)
    got = [ids for block in packing.blocks(texts) for ids in encode(block)]
    assert got == [np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for t in cases]
    assert encode([]) == [] and encode([None, ""]) == [np.array([2], "<u4").tobytes()] * 2


def test_words_kept_by_a_worker_take_little_memory():
    texts = [f"{a}{b}{c}{d}" for a in VOWELS for b in VOWELS for c in VOWELS for d in VOWELS]
    encode = packing.word_encoder(packing.tokenizer_of(packing.vocabulary_path()), 2)
    encode(["warm up"])
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    encode([" ".join(texts)])
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert kept < 80 * len(texts)


def test_a_worker_keeps_no_reserve_when_its_task_is_over(monkeypatch):
    calls: list = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append("back"))
    monkeypatch.setattr(packing, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", None]})
    for run in (packing.packing(None, 4096, 2), common.per_batch(lambda b: b.to_pydict(), batch.schema)):
        made = run(iter([batch]))
        assert sum(b.num_rows for b in made) >= 2 and set(calls) == {"back"}
        calls.clear()


def test_chat_round_trip(spark):
    hard = ["\\### Assistant: </turn> ok", "a\\", "</turn>", "### user: x", "", "\\\\</turn>\n", None, "### : ", "\n"]
    rows = [(1, k, role, t) for k, t in enumerate(hard) for role in ("user", "assistant", None)]
    made = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = chat.digests(made).first()
    order = sorted(rows, key=lambda r: (r[1], r[2] or "", r[3] or ""))
    assert got["round_trip"] and got["n_turns"] == len(rows)
    assert got["turns_sha256"] == brute.sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in order))
    assert got["loss_sha256"] == brute.sha("".join(r[3] or "" for r in order if r[2] == "assistant"))
    row = made.first()
    assert sum(r["chars"] for r in row["loss_runs"]) == len(row["formatted"])


@pytest.mark.parametrize("shard_bytes", [decontaminate.SHARD_BYTES, 1_000])
def test_decontamination(spark, given, shard_bytes):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text")
    extra = spark.createDataFrame([(901, "w1 w2"), (902, None), (903, "...")], "item_id long, text string")
    items = bench.union(extra)
    plain = {r["item_id"]: r["text"] for r in items.collect()}
    docs = given.select("doc_id", "text").union(spark.createDataFrame([(-1, "W1,  w2! w3"), (-2, None)], "doc_id long, text string"))
    got = decontaminate.find_overlap(docs, items, shard_bytes=shard_bytes).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted(
        (i, *brute.overlap(t, plain)) for i, t in texts(docs)
    )


def test_language_id(spark):
    rows = queries.QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").collect()
    said = {r["doc_id"]: r for r in rows}
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()
    held = [said[i]["lang_pred"] == lang for i, lang in truth if said[i]["held_out"]]
    assert sum(held) / len(held) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == (name == "op8_chat_format")


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain = dict(texts(docs))
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(plain[i] == t for i, t in left.items())
    hits = {i: brute.overlap(t, items)[:2] for i, t in left.items()}
    assert not any(h and 20 * h >= n for n, h in hits.values())
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(left)
    shared = spark.conf.get("spark.checkpoint.dir")
    assert [os.listdir(f"{shared}/{f}") for f in os.listdir(shared) if f.startswith("pipeline-")] == [["sequence_packing"]]


def test_pipeline_of_empty_tables(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", [n for n in oc.entry_module.oracle_sql() if n.startswith("op")])
def test_sql(spark, name):
    ok, note = oc.compare(spark, oc.connect(FOLDER), FOLDER, name)
    assert ok, note


def test_packed_keys_and_distinct_values_survive():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 48, 1000, dtype=np.uint64)) << np.uint64(16)
    for some in (keys, keys[:1], keys[:0], np.array([0, 0xFFFFFFFFFFFF0000], np.uint64)):
        assert (chunks.from_gaps(chunks.gaps(some)) == some).all()
        values = np.concatenate([some[::-1], some])
        for got, want in zip(language_model.few_distinct(values), np.unique(values, return_inverse=True)):
            assert (got == want).all()


def test_tables_of_groups_are_drawn():
    n, size, weight = 400, 3000, 50.0
    keys = np.random.default_rng(1).integers(0, 1 << 63, n, dtype=np.uint64)
    got = language_model.tables_drawn(np.full(n, size), np.full(n, weight), 0.8, keys, 0)
    luck, want = np.random.default_rng(2).random((size, n)), np.ones(n)
    for seated in range(1, size):
        want += luck[seated] < weight / (weight + seated - 0.8 * want)
    assert 0.75 < got.std() / want.std() < 1.35
    assert abs(got.mean() / want.mean() - 1) < 0.05


def test_binomial_numbers_have_their_shares():
    luck = (np.arange(40_000) + 0.5) / 40_000
    for n, share in ((2, 0.3), (9, 0.95), (500, 0.02), (100_000, 0.4)):
        got = language_model.binomial(np.full(len(luck), float(n)), np.full(len(luck), share), luck)
        assert got.min() >= 0 and got.max() <= n
        assert abs(got.mean() - n * share) < 0.01 * n * share
        assert abs(got.var() / (n * share * (1 - share)) - 1) < 0.02


def test_language_model_is_seated_anew_twice(given):
    assert language_model.SWEEPS >= 2
    trained = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    found = [
        {r["doc_id"]: r["score"] for r in language_model.score(given, trained, **how).collect()}
        for how in ({"sweeps": 0}, {"sweeps": 1}, {"sweeps": 2}, {}, {"chunk_chars": 40_000})
    ]
    assert found[0] != found[1] != found[2]
    assert all(abs(found[2][i] - x) < 1e-6 for more in found[3:] for i, x in more.items())


@pytest.mark.parametrize("n", [60, 99, 100, 150])
def test_quality_keeps_a_small_source_of_its_own_style(spark, n):
    plain = [(i, " ".join(rng.choice(VOCAB) for _ in range(60)), "en", "a") for i in range(400)]
    code = [(1000 + i, " ".join(rng.choice(VOCAB) + "##" for _ in range(60)), "en", "code") for i in range(n)]
    few = [(5000 + i, " ".join(rng.choice(VOCAB) + "##" for _ in range(60)), "en", "b") for i in range(3)]
    docs = spark.createDataFrame(plain + code + few, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality.keep_good(docs).collect()}
    assert kept == {r[0] for r in plain + code}


def test_drop_contaminated_in_shards_judges_each_row(spark):
    bench = spark.createDataFrame([(1, " ".join(BASE[:40])), (2, " ".join(BASE[50:90]))], "item_id long, text string")
    bad, clean = " ".join(BASE), " ".join(rng.choice(VOCAB) for _ in range(100))
    rows = [(None, bad), (None, clean), (None, None), (7, bad), (7, clean), (8, clean), (9, " ".join(BASE[45:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_row": F.lit(5), "_bad": F.lit("x")})
    one, many = (
        sorted(map(tuple, decontaminate.drop_contaminated(docs, bench, n).collect()), key=str)
        for n in (decontaminate.SHARD_BYTES, 1_000)
    )
    assert one == many == sorted([(i, t, 5, "x") for i, t in ((None, clean), (None, None), (7, clean), (8, clean))], key=str)


def test_weak_parts_are_linked_in_rows_without_an_id(spark):
    docs = spark.createDataFrame([(1, SECRET), (None, SECRET), (None, "secret=shorty1")], "doc_id long, text string")
    found = {(r["doc_id"], r["spans"]) for r in secrets.digests(secrets.scan(docs)).collect()}
    assert {s for i, s in found if i is None} == {next(s for i, s in found if i == 1), ""}
    masked = [r["text"] for r in secrets.mask_secrets(docs).collect()]
    assert not any("alice99" in t for t in masked) and "secret=shorty1" in masked


@pytest.fixture(scope="module")
def long_texts(spark):
    """Texts of many credentials among letters of several widths, some overlapping."""
    local = random.Random(12)
    made = []
    for i, n in enumerate((1, 127, 128, 129, 3000)):
        pieces = []
        for k in range(n):
            key = "".join(local.choices("abcdef0123456789", k=local.randint(4, 40)))
            pieces.append(local.choice([f"secret={key}", f"user: bob{k} token = {key}", f"AKIA{key.upper()}", "é\U0001f600" * 9, key, f"http://h{k}.x/"]))
        made.append((i, " ".join(pieces)))
    return spark.createDataFrame(made, "doc_id long, text string")


def test_many_secrets_in_one_text(spark, long_texts):
    found = {r["doc_id"]: r for r in secrets.digests(secrets.scan(long_texts)).collect()}
    masked = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(long_texts).collect()}
    for i, text in texts(long_texts):
        assert found[i]["base_sha256"] == brute.sha(",".join(brute.secret_base(text)))
        spans = [tuple(map(int, s.split(":")[1:])) for s in found[i]["spans"].split(",") if s]
        want, at = [], 0
        for start, end in spans:
            if start >= at:
                want.append(text[at:start])
            at = max(at, end)
        assert masked[i] == "[secret]".join([*want, text[at:]])


def test_many_turns_in_one_conversation(spark):
    local = random.Random(4)
    rows = [(1, k, ("user", "assistant")[k % 2], "é\U0001f600x </turn> " * local.randint(0, 60)) for k in range(1500)]
    got = chat.digests(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert got["round_trip"] and got["loss_sha256"] == brute.sha("".join(r[3] for r in rows[1::2]))


def test_a_part_names_the_words_of_a_row_and_a_column():
    for n in (0, 1, 2, 3, 7, 18, 1000):
        rows, columns = language_model.grid_of(n)
        assert max(n, 1) <= rows * columns < max(n, 1) + rows and columns - rows in (0, 1, 2)
    words = np.random.default_rng(6).integers(0, 1 << 63, 4000, dtype=np.uint64)
    sizes = np.bincount(language_model.grouped(words, 7), minlength=7)
    assert len(sizes) == 7 and sizes.min() > 400
