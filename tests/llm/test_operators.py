import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import ann, bpe, html_text, language_id, lattice_dedup, line_dedup, mixing, odd_minhash, unit_dedup, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_lines int, component_id string, ids string"
LONG = " ".join(f"w{i}" for i in range(30_000))
WORDS = [f"word{i}" for i in range(200)]


def documents(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", "y") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", None), (4, LONG, "en", "a"), (5, "one two", "fr", "b"), (5, "one two", "fr", "b"),
            (6, " ".join(WORDS), "en", "a"), (7, " ".join(WORDS), "en", "b"), (8, " ".join([*WORDS[:190], "changed"]), None, "b"), (None, "text without id", "en", "b")]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_duplicates(odd, empty):
    got = by_id(odd_minhash.near_duplicates(odd))
    assert {k: r["component_id"] for k, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 6, None: None}
    assert got[1]["n_shingles"] == 0 and got[5]["n_shingles"] == 1 and got[4]["n_shingles"] == 29_996
    assert [k for k, r in got.items() if not r["kept"]] == [7, 8]
    assert odd_minhash.near_duplicates(empty).count() == 0


def test_set_sketches_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(5)
    for n in (1, 40, 600, 5000):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for swapped in (0, n // 7, n):
            other = np.unique(np.concatenate([base[swapped:], rng.integers(0, 2**64, swapped, dtype=np.uint64)]))
            bits = np.bitwise_count((odd_minhash.set_sketch(base) ^ odd_minhash.set_sketch(other)).view(np.uint64)).sum()
            assert bits <= np.setxor1d(base, other).size


def test_line_dedup(spark, odd, empty):
    shared = [(i, f"  Shared LINE\nown {i}\n\nshared line ", "en", "a") for i in range(10)] + [(20, "shared line", "en", "a")]
    got = by_id(line_dedup.line_dedup(documents(spark, shared)))
    assert (got[3]["text"], got[3]["n_lines"], got[3]["n_dropped"]) == ("own 3\n", 4, 2)
    assert (got[20]["text"], got[20]["n_dropped"]) == ("", 1)
    assert got[3]["component_id"] == "x"
    kept = by_id(line_dedup.line_dedup(documents(spark, shared), keep_first=True))
    assert kept[0]["text"] == "  Shared LINE\nown 0\n" and kept[1]["text"] == "own 1\n"
    same = line_dedup.line_dedup(odd)
    assert same.count() == 10 and same.agg(F.sum("n_dropped")).first()[0] == 0
    assert by_id(same)[1]["text"] is None
    assert line_dedup.line_dedup(empty).count() == 0


def test_repeated_spans(spark, odd, empty):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"lead{i} in{i} {' '.join(f'a{i}x{j}' for j in range(i * 7))} {passage} tail{i} {' '.join(f'z{i}y{j}' for j in range(40))}", "en", "a") for i in range(1, 12)]
    clean = [(100 + i, " ".join(f"c{i}d{j}" for j in range(80)), "en", "a") for i in range(5)]
    spans = unit_dedup.repeated_spans(documents(spark, rows + clean))
    got = spans.collect()
    texts = {r[0]: r[1] for r in rows}
    assert {r["doc_id"] for r in got} == set(range(2, 12))
    assert all(texts[r["doc_id"]][r["start"] : r["stop"]] in passage and r["kept_doc_id"] == 1 and r["n_words"] >= 18 and not r["line"] for r in got)
    cut = by_id(unit_dedup.without_spans(documents(spark, rows), spans))
    assert cut[1]["text"] == texts[1] and all(len(cut[i]["text"]) < len(texts[i]) for i in range(2, 12))
    assert {r["doc_id"] for r in unit_dedup.repeated_spans(odd).collect()} == {7, 8}
    assert unit_dedup.repeated_spans(odd.where("doc_id < 4")).count() == 0
    assert unit_dedup.repeated_spans(empty).count() == 0


def test_substring_dedup_reports_repeats_inside_a_document(spark, tmp_path):
    from kindred.llm import queries

    passage = " ".join(f"p{i}" for i in range(80))
    filler = lambda k: " ".join(f"f{k}x{j}" for j in range(60))
    texts = {1: f"{filler(1)} {passage} {filler(2)} {passage} {filler(3)}", 2: f"{filler(4)} {passage} {filler(5)}",
             3: f"{filler(6)} {filler(7)} {filler(6)}", 4: f"{filler(8)} {filler(9)}"}
    docs = documents(spark, [(k, t, "en", "a") for k, t in texts.items()] + [(3, texts[3], "en", "a")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op5_substring_dedup(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["kept_doc_id"]) for r in got) == [(1, 1), (2, 1), (3, 3)]
    again = {1: texts[1].rindex("p0 "), 2: texts[2].index("p0 "), 3: texts[3].rindex("f6x0 ")}
    assert all(r["start"] >= again[r["doc_id"]] and r["n_words"] >= 18 for r in got)


def test_repeated_spans_hold_against_brute_force(spark):
    import random

    rng = random.Random(8)
    fresh = iter(range(10**6))
    prose = lambda n: [f"u{next(fresh):06d}" for _ in range(n)]
    passages = [prose(51) for _ in range(12)]
    lines = [prose(n) for n in (18, 25, 60)]
    texts, planted, whole = {}, {}, {}
    for doc in range(60):
        pieces, used = [], rng.sample(range(12), 2)
        for p in used:
            pieces += [prose(rng.randrange(5, 40)), [w.upper() for w in passages[p]] if doc % 2 else passages[p]]
        body = "  ".join(w for piece in pieces for w in piece)
        line = lines[doc % 3] if doc % 4 == 0 else None
        texts[doc] = body + ("\n " + " ".join(line) + "\t\n" if line else "\n") + " ".join(prose(10))
        planted[doc], whole[doc] = used, line
    got = {}
    for r in unit_dedup.repeated_spans(documents(spark, [(k, t, "en", "a") for k, t in texts.items()])).collect():
        got.setdefault(r["doc_id"], []).append(r)
    flat = {k: " " + " ".join(t.lower().split()) + " " for k, t in texts.items()}
    for doc, spans in got.items():
        for r in spans:
            span = " " + " ".join(texts[doc][r["start"] : r["stop"]].lower().split()) + " "
            assert r["n_words"] == len(span.split()) >= 18 and all(k < doc for k in r["kept_doc_ids"])
            assert any(span in flat[k] for k in range(doc)) or len(r["kept_doc_ids"]) > 1
    seen, seen_lines = set(), []
    for doc, used in planted.items():
        for p in used:
            at = texts[doc].lower().split()
            if p in seen:
                low = texts[doc].lower().index(passages[p][0])
                high = texts[doc].lower().index(passages[p][-1])
                assert any(r["start"] < high and r["stop"] > low for r in got[doc] if not r["line"])
            seen.add(p)
        if whole[doc] is not None:
            if whole[doc] in seen_lines:
                assert " ".join(whole[doc]) in [texts[doc][r["start"] : r["stop"]] for r in got[doc] if r["line"]]
            seen_lines.append(whole[doc])
    cut = by_id(unit_dedup.without_spans(documents(spark, [(5, "abcdefgh", "en", "a"), (5, "abc", "en", "a"), (6, None, "en", "a"), (None, "x", "en", "a")]),
        spark.createDataFrame([(5, 1, 4), (5, 2, 3), (5, 2, 3), (6, 0, 1)], "doc_id long, start int, stop int")))
    assert cut[6]["text"] is None and cut[None]["text"] == "x" and cut[5]["text"] in ("aefgh", "a")


def test_mix(spark, odd, empty):
    rows = [(i, " ".join(["w"] * (50 + i % 40)), "en", f"s{i % 5}") for i in range(400)]
    got = mixing.mixed_sizes(documents(spark, rows)).collect()
    again = mixing.mixed_sizes(documents(spark, rows).repartition(7)).collect()
    assert sorted(got) == sorted(again) and len(got) == 400
    taken = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken.setdefault(r["doc_id"] % 5, [0, r["source_size"], r["target"]])[0] += r["taken"]
    assert all(abs(t - goal) < 0.02 * goal and goal <= 2 * size for t, size, goal in taken.values())
    assert sum(t[2] for t in taken.values()) == pytest.approx(1.5 * sum(t[1] for t in taken.values()))
    mixed = mixing.mixed_sizes(odd).collect()
    assert len(mixed) == 10 and {r["size"] for r in mixed if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mixed_sizes(empty).count() == 0


def test_mix_gives_small_sources_beside_large_ones_their_targets(spark):
    import corpus_pipeline

    docs = spark.range(180).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.when(F.col("id") < 80, 100_000).otherwise(30)).alias("text"), F.lit("en").alias("lang"),
        F.concat(F.when(F.col("id") < 80, "large").otherwise("small"), F.when(F.col("id") < 80, F.col("id") % 4).otherwise(F.col("id"))).alias("source"), F.lit(0).cast("long").alias("n_chars"))
    taken = {}
    for r in mixing.mixed_sizes(docs).collect():
        got = taken.setdefault(r["doc_id"] if r["doc_id"] >= 80 else -1 - r["doc_id"] % 4, [0, r["target"]])
        got[0] += r["taken"]
    assert len(taken) == 104 and all(abs(t - goal) <= max(2, 0.02 * goal) for t, goal in taken.values())
    assert corpus_pipeline.mix(spark, docs, "").where("doc_id >= 80").count() == 200


def test_bpe_equals_the_public_encoder(odd, empty):
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    import base64

    path = public.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    want = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.decode(bpe.encode(odd, path, public.PATTERN), path, public.PATTERN).collect()
    assert len(got) == 10
    for r in got:
        assert r["ids"] == want.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    encoder = bpe.Encoder(bpe.Vocabulary(path, public.PATTERN))
    for t in ("a  b \n c", " x", "don't  STOP\t", "é\x85ü　z", "a" * 300, "<|endoftext|>", "   "):
        packed = encoder.packed(t)
        assert list(struct.unpack(f"<{len(packed) // 4}i", packed)) == want.encode_ordinary(t)
    assert bpe.encode(empty, path, public.PATTERN).count() == 0


def test_bpe_round_trip_takes_one_python_worker(spark, odd, empty):
    public = pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    path = public.path("byte_bpe_multi_50k.tiktoken")
    rows = lambda df: sorted(df.select("doc_id", "ids", "decoded").collect(), key=str)
    assert rows(bpe.round_trip(odd, path, public.PATTERN)) == rows(bpe.decode(bpe.encode(odd, path, public.PATTERN), path, public.PATTERN))
    assert bpe.round_trip(empty, path, public.PATTERN).count() == 0
    plan = corpus_pipeline.tokens(spark, odd.withColumn("source", F.lit("s")), "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_language_id(spark, odd, empty):
    voices = {"en": ["the", "with", "and", "house"], "fr": ["le", "avec", "été", "maison"], "de": ["der", "mit", "über", "haus"]}
    rows = [(i, " ".join(voices[lang][(i * j) % 4] for j in range(1, 20)), lang, "a") for i, lang in enumerate(["en", "fr", "de"] * 40)]
    docs = documents(spark, rows)
    fitted = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    held = language_id.predict(docs, fitted).where(language_id.held_out(F.col("doc_id"))).collect()
    assert held and all(r["lang"] == r["lang_pred"] and 0 <= r["score"] <= 1 for r in held)
    got = by_id(language_id.predict(odd, fitted))
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[4]["lang_pred"] in voices
    assert language_id.fit(empty) is None and language_id.predict(empty, None).count() == 0


def test_main_text(spark):
    page = ("<html><head><title>T</title><script>x='</p>'</script></head><body><nav><a href=/>Home</a></nav><div class='ad'>Buy this now please.</div>"
            "<article><h1>Title &amp; more</h1><p>First <b>part<br>of it.<p>Second.</article><section id=comments><p>" + "nice post " * 20 + "</section><footer>&copy; me</footer>")
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p"), (4, "<p")], "page_id long, html string")
    got = [r["text"] for r in html_text.extract(df).orderBy("page_id").collect()]
    assert got == ["Title & more\n\nFirst part of it.\n\nSecond.", "", "", "", ""]
    assert html_text.extract(df.limit(0)).count() == 0


def test_url_filter(spark):
    day = lambda n: f"2024-01-{n:02d}"
    captures = spark.createDataFrame([
        (1, "http://a.b.com/x/y", day(5)), (2, "http://a.b.com/x/y", day(1)), (3, "http://A.b.com:80/z", day(25)), (4, None, day(5)), (5, "not a url", day(5)),
        (6, "http://c.b.com/", None), (1, "http://a.b.com/x/y", day(5)), (7, "http://c.b.com/", day(9))], "page_id long, url string, fetched_at string")
    entries = spark.createDataFrame([
        ("host", "a.b.com", "block", day(3)), ("host", "a.b.com", "clear", day(20)), ("prefix", "a.b.com/x/", "allow", day(4)), ("domain", "b.com", "block", day(9)),
        ("host", None, "block", day(1)), ("odd", "a.b.com", "block", day(1))], "scope string, value string, action string, since string").withColumn("since", F.col("since").cast("timestamp"))
    got = [(r["page_id"], r["verdict"], r["matched"]) for r in url_filter.filter_urls(captures, entries).orderBy("page_id").collect()]
    assert got == [(1, "allow", "p:a.b.com/x"), (1, "allow", "p:a.b.com/x"), (2, "allow", None), (3, "block", "d:b.com"), (4, "allow", None),
                   (5, "allow", None), (6, "allow", None), (7, "block", "d:b.com")]
    assert url_filter.filter_urls(captures.limit(0), entries).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 16))
    x[100:130] = x[5] + 0.02 * rng.normal(size=(30, 16))
    x[130:140] = x[5]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0), (1003, [None] * 16, 0), (1004, [1.0], 0), (None, [1.0] * 16, 0), (0, rows[0][1], 0)]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")


def test_nearest(vectors):
    import numpy as np

    x, df = vectors
    got = ann.nearest(df, df.where("vec_id % 100 = 0"), list_rows=20).collect()
    hits = 0
    for q in (0, 100, 200):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(300), d))[:10]
        rows = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 11)) and all(r["score"] == pytest.approx(d[r["vec_id"]], rel=1e-12) for r in rows)
        hits += len({r["vec_id"] for r in rows} & set(want.tolist()))
    assert hits >= 27 and {r["query_id"] for r in got} == {0, 100, 200}
    assert ann.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2000, 7])
def test_embedding_groups(vectors, block):
    import numpy as np

    x, df = vectors
    got = {r["vec_id"]: r for r in lattice_dedup.embedding_groups(df, block_rows=block).collect()}
    n = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    close = n @ n.T >= 0.95
    np.fill_diagonal(close, False)
    for i in range(300):
        assert got[i]["n_links"] == close[i].sum()
        assert got[i]["component_id"] == (5 if close[i].any() else i)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (1000, 1001, 1002, 1003, 1004, None))
    assert lattice_dedup.embedding_groups(df.limit(0)).count() == 0


def test_pipeline_bounds_its_batches(spark):
    import corpus_pipeline

    keys = [f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = {k: spark.conf.get(k, None) for k in keys}
    docs = spark.createDataFrame([(1, "a b c", "s")], "doc_id long, text string, source string")
    try:
        for k in keys:
            spark.conf.unset(k)
        assert corpus_pipeline.tokens(spark, docs, "").first()["exact"]
        assert [int(spark.conf.get(k)) for k in keys] == [250, 2 << 20]
        spark.conf.set(keys[0], "7")  # what the session states stays
        corpus_pipeline.tokens(spark, docs, "")
        assert spark.conf.get(keys[0]) == "7"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_pipeline(spark, tmp_path, monkeypatch):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rows = [(i, f"the house number {i} stands here and " + " ".join(f"word{i}x{j}" for j in range(30)) + "\nboilerplate line", "en", f"s{i % 2}", 5) for i in range(12)]
    rows += [(50, rows[0][1], "en", "s0", 5), (51, "12345", "en", "s0", 5), (52, None, None, None, None)]
    rows += [(None, f"this tree without an id grows there and {' '.join(f'leaf{j}' for j in range(30))}", "en", "s1", 5)]
    rows += [(60, "a very long house " + " ".join(f"w{i}" for i in range(40_000)), "en", "s1", 5), (61, "Ja.", "en", "s0", 5)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, n_lines int, component_id string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, str(tmp_path)).collect()}
    assert kept == {None, *range(12), 50, 60, 61}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in out}
    assert ids <= {None, *range(12), 60, 61} and len(ids) >= 10 and None in ids and all(r["exact"] and r["n_tokens"] for r in out)
    assert len(corpus_pipeline.STAGES) == 5
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0



def test_repeated_ids_keep_their_links_in_any_row_order(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (1, a)]
    seen = set()
    for turned in (rows, rows[::-1]):
        df = documents(spark, [(*r, "en", "s") for r in turned]).coalesce(1)
        seen.add(tuple(sorted((r["doc_id"], r["component_id"]) for r in odd_minhash.near_duplicates(df).collect())))
    assert len(seen) == 1 and next(iter(seen)) in {((1, 1), (2, 1), (3, 3)), ((1, 1), (2, 2), (3, 1))}


def test_near_duplicates_equal_brute_force(spark):
    import random
    import re

    rng = random.Random(3)
    words_ = [f"w{i}" for i in range(300)]
    texts = {}
    for base in range(6):
        own = [rng.choice(words_) for _ in range(rng.choice((3, 40, 90, 200)))]
        for copy in range(12):
            w = list(own)
            for _ in range(rng.choice((0, 0, 1, 2, 4, 8))):
                w[rng.randrange(len(w))] = rng.choice(words_)
            texts[base * 100 + copy] = " ".join(w).upper() if copy % 3 else "\n".join(w)

    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {k: grams(t) for k, t in texts.items()}
    root = {k: k for k in texts}
    for x in texts:
        for y in texts:
            if 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                low, high = sorted((root[x], root[y]))
                root = {k: low if r == high else r for k, r in root.items()}
    got = by_id(odd_minhash.near_duplicates(documents(spark, [(k, t, "en", "a") for k, t in texts.items()])))
    assert {k: r["component_id"] for k, r in got.items()} == root
    assert {k: r["n_shingles"] for k, r in got.items()} == {k: len(s) for k, s in sets.items()}


def test_rough_filter_keeps_every_asked_id(spark):
    from kindred.llm.common import roughly_among, written

    ids = written(spark.range(0, 5000, 7).select(F.col("id").alias("k")), "ids")
    for most in (1 << 27, 1 << 16, 1 << 15):
        got = {r["k"] for r in roughly_among(spark.range(100_000).select(F.col("id").alias("k")), ids, "k", most).collect()}
        assert got >= set(range(0, 5000, 7)) and (len(got) < 25_000)
    assert roughly_among(spark.range(10).select(F.col("id").alias("k")), ids.limit(0), "k").count() == 0


def test_components_of_paths_and_hubs(spark):
    from kindred.llm.common import components

    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 300), (300, 250), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in (200, 250, 300)}


@pytest.mark.parametrize("easy", [1000, 3])
def test_line_dedup_equals_brute_force(spark, monkeypatch, easy):
    import random
    from collections import defaultdict

    monkeypatch.setattr(line_dedup, "EASY", easy)
    rng = random.Random(4)
    pool = [f"line {i}" for i in range(40)] + ["hot line"] * 60 + ["", "  "]
    texts = {i: "\n".join(rng.choice(("", " ", "\t")) + rng.choice(pool).upper() for _ in range(rng.randrange(9))) for i in range(300)}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    held = defaultdict(list)
    for i, t in texts.items():
        for p, line in enumerate(t.split("\n")):
            if key(line):
                held[key(line)].append((i, p))
    for keep_first in (False, True):
        gone = set()
        for at in held.values():
            if len({i for i, _ in at}) >= 4:
                gone |= set(at) - ({min(at)} if keep_first else set())
        want = {i: "\n".join(line for p, line in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in texts.items()}
        got = by_id(line_dedup.line_dedup(documents(spark, [(i, t, "en", "a") for i, t in texts.items()]), min_docs=4, keep_first=keep_first))
        assert {i: r["text"] for i, r in got.items()} == want
        assert sum(r["n_dropped"] for r in got.values()) == len(gone)


def _prose(n, word):
    return " ".join(f"{word}{i}" for i in range(n))


def test_main_text_of_odd_pages():
    a, b, c = _prose(40, "a"), _prose(30, "b"), _prose(22, "c")
    pages = {
        f"<html><head><title>x</title><meta charset=utf-8><body><article><p>{a}</p><p>{b}</p></article>": [a, b],
        f"<html><head><title>x</title><p>{a}</p><p>{b}</p>": [a, b],
        f"<body><div class='content social-science'><p>{a}</p><p>{b}</p></div>": [a, b],
        f"<body><nav><a href=x>x</a></nav><article class='search-algorithms'><h1>One two</h1><p>{a}</p></article>": ["One two", a],
        f"<body><div id='legal-history'><p>{a}</p><p>{b}</p></div><footer>me</footer>": [a, b],
        f"<body><form action=x><div><a href=y>home</a></div><article><p>{a}</p><p>{b}</p></article></form>": [a, b],
        f"<body><form action=x><div><a href=y>home</a></div><p>{a}</p><p>{b}</p></form>": [a, b],
        f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p><p>{a}</p></article>": ["Let x=2 be.", a],
        f"<body><article><p>{a}</p><p>{b}</p></article><section><h2>Responses</h2><div><p>{c}</p></div></section>": [a, b],
        f"<article><p>Seen <span hidden>secret <b>bold</b> leak</span> after.</p><p>{a}</p></article>": ["Seen after.", a],
        f"<article><p>First <script>v='</p>'</script>second <button>Share</button>third.</p><p>{a}</p></article>": ["First second third.", a],
        f"<article><h1>T</h1><p>{a}</p><div class='advert'>{c}</div><p>{b}</p><div id=comments><p>{c}</p></div></article>": ["T", a, b],
        f"<article><table><tr><td>u<td>v<tr><td>w</table><p>{a}</article>": ["u", "v", "w", a],
        f"<article><p>{a}<div>{b}</div>": [a, b],
        "<article>" + f"<p>{a}</p>" * 3000 + "</article>": [a] * 3000,
        "<div>" * 5000 + "</b></p>" * 5000 + f"<article><p>{a}</p></article>": [a],
    }
    for page, want in pages.items():
        assert html_text.main_text(page) == "\n\n".join(want), page[:120]


def test_main_text_equals_the_article_element(spark):
    import html
    import re
    from pathlib import Path

    path = "/root/testdata/sf0.01/pages.parquet"
    if not Path(path).exists():
        pytest.skip("no test tables")
    for r in html_text.extract(spark.read.parquet(path)).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        pieces = re.split(r"</?(?:p|h1|footer|body|html)>", inner)
        plain = (" ".join(html.unescape(re.sub(r"<br[^>]*>", " ", x).replace("<b>", "").replace("</b>", "")).split()) for x in pieces)
        assert r["text"] == "\n\n".join(p for p in plain if p)


def test_main_text_tree_uses_words_and_densities(spark):
    assert {"words", "links"} <= html_text.extractor().tree.used()
    rows = [(1, "<p>" + _prose(30, "a") + "</p>", "old", 5)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, html string, text string, words int")).first()
    assert got["text"] == _prose(30, "a") and got["words"] == 5


def test_language_id_kernel_equals_a_plain_computation():
    texts = ["The house, and the tree", "le chat et la maison", "der Baum", "x", "haus und baum 12", "été"]
    model = language_id.Model(texts[:4], ["en", "fr", "de", "de"], 8, 0.1, 7)

    def grams(text, n):
        raw = language_id.letters(text).encode()
        return {raw[i : i + n] for i in range(len(raw) - n + 1)}

    marks = [texts[0], texts[1], texts[2], texts[3]]
    plain = np.array([[sum(len(grams(x, n) & grams(y, n)) / np.sqrt(max(1, len(grams(x, n))) * max(1, len(grams(y, n)))) for n in (1, 2, 3)) / 3 for y in marks] for x in texts])
    got = model.kernel(texts)
    # Landmarks come in the order in which they were picked; every plain column is among the kernel's.
    for column in plain.T:
        assert min(np.abs(got - column[:, None]).max(axis=0)) < 1e-6
    assert model.predict(texts[:3])[0] == ["en", "fr", "de"]
    assert language_id.letters("नमस्ते, दुनिया! Ünï1x") == " नमस्ते दुनिया ünï x "


def test_language_id_odd_columns_and_ties(spark):
    rows = [(i, t, lang, 1, 2) for i, (t, lang) in enumerate([("the house and the tree", "en"), ("le chat et la maison", "fr")] * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, __name int, named int")
    fitted = language_id.fit(docs)
    got = language_id.predict(docs, fitted)
    assert got.columns == ["doc_id", "text", "lang", "__name", "named", "lang_pred", "score"]
    assert all(r["lang"] == r["lang_pred"] and r["__name"] == 1 for r in got.collect())
    assert language_id.predict(docs.select("text"), fitted).columns == ["text", "lang_pred", "score"]
    with pytest.raises(ValueError, match="labels"):
        language_id.fit(docs, max_classes=1)
    # Short clean texts of a known language are named, and the pipeline keeps them.
    small = language_id.fit(docs, sample_chars=1)
    assert set(small.classes) == {"en", "fr"}


def test_nearest_in_blocks_of_several_lists(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([c + rng.normal(size=(150, 12)) for c in rng.normal(size=(12, 12)) * 4])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 9 = 0"), list_rows=40, slice_rows=30, query_block=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    hits = total = 0
    for q in range(0, len(x), 9):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = set(np.lexsort((np.arange(len(x)), d))[:10].tolist())
        assert [rank for rank, _ in sorted(got[q])] == list(range(1, 11))
        hits, total = hits + len(want & {v for _, v in got[q]}), total + 10
    assert hits / total >= 0.9


def test_nearest_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(30)] + [(100, [1.0, 0.5])], "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, df.where("vec_id = 100")).collect())
    assert got == [(i + 1, i, 0.5) for i in range(10)]


def test_url_filter_of_long_urls_and_clashing_names(spark):
    long = "http://h.example/" + "/".join(f"s{i}" for i in range(800)) + "?q=" + "x" * 5000
    captures = spark.createDataFrame([(1, long, "2024-01-05", "mine", 3)], "page_id long, url string, fetched_at string, key string, row int")
    entries = spark.createDataFrame([("prefix", "h.example/s0/s1", "block", "2024-01-01", "z")], "scope string, value string, action string, since string, until string").withColumn("since", F.col("since").cast("timestamp"))
    got = url_filter.filter_urls(captures, entries).collect()
    assert [(r["verdict"], r["matched"]) for r in got] == [("block", "p:h.example/s0/s1")]
    assert url_filter.filter_urls(captures, entries.limit(0)).first()["verdict"] == "allow"
