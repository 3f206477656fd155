"""Sharding, mixing, WARC archives, token files and the pipeline."""

import gzip
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tabforge.llm import mixing, sharding, tokens, warc
from tabforge.llm.stage import Stage

from .test_dedup import brute_classes
from .util import corpus, frame, prose

SF = "/root/testdata/sf0.001"


def size(text):
    return len((text or "").encode()) + 1


def test_shards_match_brute_force(spark):
    rows = corpus()
    got = sharding.shard_assignments(spark, frame(spark, rows), 7).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), size(r[1])))
    total, before, want, slots = sum(size(t) for _, t in rows), 0, [], defaultdict(int)
    for i, t in order:
        shard = (2 * before + size(t)) * 7 // (2 * total)
        want.append((i, size(t), zlib.crc32((t or "").encode()), shard, slots[shard]))
        slots[shard] += 1
        before += size(t)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == Counter(want)
    same = sharding.shard_documents(spark, frame(spark, rows), 7)
    assert same.columns == [*frame(spark, rows).columns, "_shard"]
    by = Counter((r.doc_id, r.text, r._shard) for r in same.collect())
    last = {}
    for (i, t), w in zip(order, want):
        last[(i, t or "")] = w[3]
    assert by == Counter((i, t, last[(i, t or "")]) for i, t in rows)
    assert sharding.shard_assignments(spark, frame(spark, [])).collect() == []
    assert sharding.shard_documents(spark, frame(spark, [])).collect() == []


def brute_share(budget, caps, weights):
    """Hand out in rounds: what a full child leaves goes to its siblings by weight."""
    got, open_, left = {c: 0 for c in caps}, set(caps), budget
    while open_ and left:
        w = sum(weights[c] for c in open_)
        full = {c for c in open_ if (caps[c]) * w <= left * weights[c]}
        if not full:
            for c in open_:
                got[c] = left * weights[c] // w
            break
        c = min(full, key=lambda c: (caps[c] / weights[c], c))
        got[c], left = caps[c], left - caps[c]
        open_.remove(c)
    return got


def test_budgets_match_rounds(spark):
    rng = random.Random(6)
    for budget, epochs in ((500, 1), (2000, 2), (10 ** 6, 1), (0, 1)):
        leaves = [(d, x, s, rng.randrange(0, 300), wd, wx, rng.randrange(0, 4)) for d, wd in (("p", 3), ("q", 1)) for x, wx in (("en", 5), ("fr", 1))
                  for s in "abc"]
        df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long, w_domain long, w_lang long, w_source long")
        got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(df, budget, epochs).collect()}
        live = [x for x in leaves if x[6] > 0]
        cap, w = defaultdict(int), {}
        for d, x, s, t, wd, wx, ws in live:
            for path, weight in (((d,), wd), ((d, x), wx), ((d, x, s), ws)):
                cap[path] += t * epochs
                w[path] = weight
        given = {(): min(budget, sum(t * epochs for *_, t, _, _, _ in live))}
        for depth in (1, 2, 3):
            for parent in {p[:depth - 1] for p in cap if len(p) == depth}:
                kids = {p: cap[p] for p in cap if len(p) == depth and p[:-1] == parent}
                given.update(brute_share(given[parent], kids, w))
        assert got == {p: given[p] for p in cap if len(p) == 3}


def test_mix_takes_prefixes_and_repeats_epochs(spark):
    rows = [(i, "w " * (i % 9 + 1), "en" if i % 3 else "fr", f"s{i % 4}") for i in range(80)] + [(500, None, None, None), (3, "w " * 4, "en", "s3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("leaf", F.lit(1)).withColumn("epoch", F.lit(2))
    weights = {"domain": F.lit(1), "lang": F.when(F.col("lang") == "fr", 9).otherwise(1), "source": F.lit(1)}
    out = mixing.mix(spark, docs, F.lit("d"), weights, 100, epochs=3)
    got = out.collect()
    assert out.columns[:6] == docs.columns
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    taken = sum(r._tokens for r in got)
    assert total - 20 <= taken <= total + 100
    fr = sum(r._tokens for r in got if r.lang == "fr")
    supply = sum(len(t.split()) for _, t, x, _ in rows if x == "fr")
    assert fr > supply * 1.9 or fr == 3 * supply  # weights want 9 of 10 words, so French is used in several epochs
    assert all(sum(r._epoch == 0 for r in got if r.doc_id == i) >= 1 for i in range(0, 80, 3))
    again = mixing.mix(spark, docs.repartition(5), F.lit("d"), weights, 100, epochs=3).collect()
    assert Counter((r.doc_id, r._epoch) for r in again) == Counter((r.doc_id, r._epoch) for r in got)
    assert mixing.mix(spark, docs.limit(0), F.lit("d"), weights, 50).collect() == []


def pages():
    rng = random.Random(3)
    big = "<p>" + "".join(rng.choice("abcé☕ \n") for _ in range(60_000)) + "WARC/1.1\r\n\r\n</p>"
    same = "<b>" + "x" * 200 + "</b>"
    return [(5, "http://a/5", same), (2, "http://a/2", same), (9, None, same), (1, "http://a/1", big), (3, "u", big), (4, "u", "short"),
            (6, "u", "short"), (7, "u", None), (8, "u", ""), (None, "u", same), (2, "http://a/2", same), (10, "u\r\nX-Evil: 1", "y" * 99)]


@pytest.mark.parametrize("segment,archive", [(warc.SEGMENT, warc.ARCHIVE), (700, 20_000)])
def test_archives_round_trip(spark, segment, archive):
    import hashlib
    path = Stage(spark, "test-warc").path("w")
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("first", F.lit(0))
    warc.write_archives(spark, df, path, segment=segment, archive=archive)
    got = Counter(tuple(r) for r in warc.read_archives(spark, path).collect())
    first, want = {}, Counter()
    for i, _, h in pages():
        if i is not None and (h not in first or i < first[h]):
            first[h] = i
    for i, _, h in pages():
        raw = (h or "").encode()
        again = i is not None and len(raw) >= 100 and first[h] < i
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None, True)] += 1
    assert got == want


def test_incomplete_messages_are_reported(spark):
    path = Stage(spark, "test-warc").path("lost")
    records = [list(warc.page_records(i, "u", (f"{i}" * 5000).encode(), "0" * 64, None, 1000)) for i in (1, 2)]
    keep = [r.decode() for r in records[0][:-1]] + [r.decode() for r in records[1] if b"Segment-Number: 3" not in r]
    spark.createDataFrame([(r,) for r in keep], "v string").write.option("lineSep", warc.END).text(path)
    got = warc.read_archives(spark, path).collect()
    assert {r.page_id: r.verified for r in got} == {1: False, 2: False} and all(r.payload_bytes is None for r in got)


def test_chunked_framing():
    data = ("é☕x" * 9000).encode()
    assert warc.unchunked(warc.chunked(data, 100)) == data and warc.unchunked(warc.chunked(b"")) == b""
    one = b"\r\n\r\n".join([b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 2", b"ab", b""])
    assert [r[0] for r in warc.parse_archive(gzip.compress(one + one))] == ["<a>", "<a>"]


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_ids_equal_the_tokenizers(tokenizer_path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path)
    texts = [x for _, x in corpus()] + ["a<|endoftext|>b don't I'm 12３４ \x85q é ΟΔΟΣ <|startoftext|> ☕️", "İ ǅ ẞ <|ENDOFTEXT|> X<|endoftext|>Y!",
                                        "A1b2—!?é! ’S o’clock Don'T <| a"]
    cache = tokens.WordIds(8)
    for _ in range(2):
        ids, counts = tokens.encode_texts(pa.array(texts), t, cache, 1)
        at = 0
        for x, n in zip(texts, counts.tolist()):
            assert ids[at:at + n].tolist() == t.encode(x or "", add_special_tokens=False).ids + [1]
            at += n


def test_any_other_tokenizer_encodes_whole_texts(spark, tokenizer_path):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    cased = Tokenizer(models.WordLevel({"Hello": 0, "hello": 2, "?": 1, "Hello hello": 5}, unk_token="?"))
    cased.pre_tokenizer = pre_tokenizers.Whitespace()
    same = Tokenizer.from_file(tokenizer_path)
    assert tokens.works_by_words(same) and not tokens.works_by_words(cased)
    other = Tokenizer.from_file(tokenizer_path)
    other.normalizer = normalizers.NFC()
    texts = ["Hello hello", None, "", "hello  HELLO"]
    for t in (cased, other):
        assert not tokens.works_by_words(t)
        ids, counts = tokens.encode_texts(pa.array(texts), t, tokens.WordIds(8), 9)
        want = [[*t.encode(x or "", add_special_tokens=False).ids, 9] for x in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want]


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_files_round_trip(spark, tokenizer_path, encoding):
    from tokenizers import Tokenizer
    import struct
    t, rows = Tokenizer.from_file(tokenizer_path), corpus()
    path = Stage(spark, "test-tokens").path("t")
    tokens.write_tokens(spark, frame(spark, rows), path, tokenizer_path, encoding=encoding)
    want, start = [], 0
    enc = [(i, t.encode(x or "", add_special_tokens=False).ids + [1]) for i, x in rows]
    got = tokens.token_digests(spark, path).collect()
    pack = lambda ids: zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), pack(x)) for i, x in enc)
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
        want.append(r.doc_id)
    assert want == sorted(want, key=lambda i: (i is not None, i or 0))
    one = tokens.read_tokens(spark, path, ["doc_id", "ids"], F.col("doc_id") == 7).collect()
    assert [r.ids for r in one] == [x for i, x in enc if i == 7]
    plan = tokens.read_tokens(spark, path, ["doc_id", "n_tokens"], F.col("doc_id") > 7)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(doc_id,7)" in plan and "ids" not in plan
    empty = Stage(spark, "test-tokens").path("none")
    tokens.write_tokens(spark, frame(spark, []), empty, tokenizer_path)
    assert tokens.token_digests(spark, empty).collect() == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        out = Stage(spark, "test-pipeline").put(name, step(spark, docs, SF))
        seen[name] = (docs, out)
        if name != "sharding":
            assert out.columns == docs.columns
        docs = out
    before, after = seen["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    classes = brute_classes(rows)
    assert {r.doc_id for r in after.collect()} == {i for i, c in classes.items() if i == c}
    before, after = seen["mixing"]
    assert 0 < after.count() <= before.count() and after.select("doc_id").distinct().count() == after.count()
    before, after = seen["sharding"]
    assert after.count() == before.count() and set(after.columns) == {*before.columns, "shard"}
    ends = after.groupBy("shard").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).orderBy("shard").collect()
    assert all(a.hi < b.lo for a, b in zip(ends, ends[1:]))


def test_every_operator_is_registered():
    names = E.queries()
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] and "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_pipeline_stages_on_hostile_rows(spark):
    rows = corpus(21)
    docs = frame(spark, rows).withColumn("n_chars", F.length("text"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 != 0, "en")).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "src7"))
    docs = docs.withColumns({c: F.lit("y") for c in ("domain", "tokens", "epoch", "leaf", "key", "item_id", "a", "b", "budget", "component_id")})
    at = Stage(spark, "test-hostile")
    kept = {}
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, step in corpus_pipeline.STAGES:
            now = at.put(f"{name}-{empty}", step(spark, now, SF))
            assert now.columns[:len(docs.columns)] == docs.columns or name == "sharding"
            kept[name] = now.count()
        assert not empty or now.count() == 0
        if not empty:
            classes = brute_classes(rows)
            ids = [r.doc_id for r in at.spark.read.parquet(at.path("near_duplicates-False")).collect()]
            assert {i for i in ids if i is not None} == {i for i, c in classes.items() if i == c}
            assert ids.count(None) == 2 and ids.count(10) == 1  # the rows without an id differ in text


def test_pipeline_judges_rows_by_their_text(spark, tmp_path):
    """Rows that share a doc_id or have none: both texts of a clash stay, copies and contaminated rows go."""
    rng = random.Random(31)
    item, clean, copied = prose(rng, 30), [prose(rng, 60) for _ in range(6)], prose(rng, 80)
    rows = [(1, clean[0]), (1, clean[1]), (None, clean[2]), (None, clean[3]), (None, copied), (7, copied), (9, copied), (9, clean[4]), (9, clean[4]),
            (None, prose(rng, 20) + " " + item), (1, item + " " + prose(rng, 9)), (None, None), (None, None), (4, "the"), (4, ""), (5, clean[5] + " the")]
    spark.createDataFrame([(1, item), (2, "the")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_row": F.lit(1), "lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(0)})
    alone = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert Counter((r.doc_id, r.text) for r in alone.collect()) == Counter(set(rows) - {(None, copied), (9, copied)})
    left = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(r for r in rows if item not in (r[1] or ""))


def test_mixing_keeps_the_budget_with_null_and_repeated_ids(spark):
    rows = [(None, f"a b c {i}") for i in range(500)] + [(i, "a b c d") for i in range(300)] + [(1000, "same old words here")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")}).repartition(5)
    weights = {"domain": F.lit(1), "lang": F.lit(1), "source": F.lit(1)}
    for percent, seed in ((10, 1), (10, 2), (37, 3), (37, 4), (37, 5), (100, 6)):
        out = mixing.mix(spark, docs, F.lit("d"), weights, percent, seed=seed).collect()
        assert sum(r._tokens for r in out) == 40 * percent
        assert not Counter((r.doc_id, r.text) for r in out) - Counter(rows)
