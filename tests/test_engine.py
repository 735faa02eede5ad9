import random

import pytest
from pyspark.sql import functions as F

from kindred.functions import fuzzy, subsequence, text
from kindred.functions.features import FEATURES_16, features_16, missed_diagnostics
from kindred.operators import blocking, evaluate, model, pairs, qa, rare, reports, tfidf
from kindred.plans import resolve
from kindred.sources import tables


def lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_scores_match_brute_force():
    rng = random.Random(42)
    word = lambda n: "".join(rng.choices("abcdefg ", k=rng.randint(0, n)))
    for _ in range(300):
        a, b = word(12), word(12)
        assert subsequence.lcs(a, b) == lcs_table(a, b)
        s, t = (a, b) if len(a) <= len(b) else (b, a)
        ways = [(s, t), (t, s)] if len(s) == len(t) else [(s, t)]
        best = 0.0
        for s, t in ways:
            for i in range(len(t)):
                for j in range(i + 1, len(t) + 1):
                    if j - i == len(s) or (j - i < len(s) and (i == 0 or j == len(t))):
                        best = max(best, fuzzy.ratio_of(s, t[i:j]))
        expected = (100.0 if a == b else 0.0) if not a or not b else best
        assert fuzzy.partial_ratio_of(a, b) == pytest.approx(expected)
    assert fuzzy.ratio_of("", "") == 100.0 and fuzzy.token_set_ratio_of("", "a") == 0.0


def test_normalizers(spark):
    rows = [("Café  Étoile™",), ("straße & Co.",), (None,), ("",), ("ﬁne Ltd.",)]
    df = spark.createDataFrame(rows, "x string")
    got = df.select(text.normalize_basic("x"), text.unicode_name("x"), text.blocking_name("x")).collect()
    assert [r[0] for r in got] == [fuzzy.normalize_basic_of(x) for (x,) in rows] == ["cafe etoile", "strae co", "", "", "fine ltd"]
    assert [r[1] for r in got] == ["café étoiletm", "strasse and co", "", "", "fine ltd"]
    assert got[1][2] == "straße and company" and got[2][2] == ""


def test_grams_and_id_lists(spark):
    df = spark.createDataFrame([("abc d", " S2-1, ,S3-2,S2-1"), ("ab", None), ("", "")], "x string, ids string")
    got = df.select(text.char_ngrams("x", 3), text.id_list("ids"), text.word_boundary_grams("x", 2, 3)).collect()
    assert got[0][0] == ["abc", "bcd"] and got[1][0] == [] and got[2][0] == []
    assert got[0][1] == ["S2-1", "S3-2"] and got[1][1] == [] and got[2][1] == []
    assert got[1][2] == [" a", "ab", "b ", " ab", "ab "] and got[2][2] == []


def records(spark, rows):
    return spark.createDataFrame(rows, tables.RECORD)


@pytest.fixture(scope="module")
def sources(spark):
    s1 = records(spark, [("S1-11", "Bäckerei Lindgrün", "7 Mühlgasse Graz", "Austria"), ("S1-12", "Nordwind Logistics", "230 Harbour Quay", "Malta"),
                         ("S1-13", "", "", "Nowhere"), ("S1-14", "Quarzwerk Holdnig", "88 Steinbruch Weg", "Austria")])
    s2 = records(spark, [("S2-71", "BACKEREI LINDGRUN", "7 Muhlgasse, Graz", "Austria"), ("S2-72", "Bäckerei Lindgrün", "7 Mühlgasse Graz", "Malta"),
                         ("S2-73", "Quarzwerk Holding", "88 Steinbruchweg", "Austria")])
    s3 = records(spark, [("S3-31", "Nordwind Logistics", "230 Harbour Quay", "Malta"), ("S3-32", "Bäckerei Lindgrün", "7 Mühlgasse Graz", "Austria")])
    return s1, s2, s3


def test_retrieval_stays_in_the_country(spark, sources):
    s1, s2, s3 = sources
    s1, others = resolve.normalized(s1), blocking.targets(resolve.normalized(s2), resolve.normalized(s3))
    got = rare.production_candidates(s1, others).collect()
    want = {("S1-11", "S2-71"), ("S1-11", "S3-32"), ("S1-12", "S3-31"), ("S1-14", "S2-73")}
    assert {(r["s1_id"], r["candidate_id"]) for r in got} == want
    assert {r["candidate_id"] for r in got if r["both_exact"]} == {"S2-71", "S3-32", "S3-31"}
    stored = rare.postings(rare.grams(others))
    assert {(r["s1_id"], r["candidate_id"]) for r in rare.production_candidates(s1, others, stored).collect()} == want
    hashed = rare.production_candidates(s1, others, bucket_bits=20).collect()
    assert {(r["s1_id"], r["candidate_id"]) for r in hashed} >= want
    assert {(r["s1_id"], r["candidate_id"]) for r in rare.scanning_candidates(s1, others).collect()} == want
    ranked = tfidf.candidates(s1, others).collect()
    assert {(r["source1_entity_id"], r["candidate_entity_id"]) for r in ranked if r["retrieval_score"] > 0.99} >= {("S1-12", "S3-31"), ("S1-11", "S3-32")}


def test_grams_as_numbers_hit_what_grams_as_texts_do(spark, monkeypatch):
    from kindred.operators import packed

    rng = random.Random(5)
    texts = ["", "ab", "a b c d", "zz9 " * 30, *(" ".join(rng.choices(("alder", "birch7", "c", "dogwood", "elm 0", "fir"), k=rng.randint(1, 9))) for _ in range(60))]
    rows = lambda p, n: [(f"{p}-{i % 55}", rng.choice(texts), rng.choice(texts), rng.choice("AAB")) for i in range(n)]  # noqa: E731  some ids repeat
    s1, others = (spark.createDataFrame(r, "entity_id string, name string, address string, country string") for r in (rows("S1", 60), rows("S2", 60) + rows("S3", 60)))
    index = rare.postings(rare.grams(others))
    chosen = rare.anchors(rare.grams(s1), index.select("country", "kind", "gram", "df").distinct())
    want = sorted(rare.hits(chosen, index).collect())
    for held, characters in ((8_000_000, 2_000_000), (20, 50)):
        monkeypatch.setattr(packed, "HELD", held)
        monkeypatch.setattr(packed, "CHARACTERS", characters)
        found = rare.anchor_hits(s1, others)
        assert sorted(found.collect()) == want and len(want) > 100
    # Before, all grams of all targets were shuffled, as texts and twice.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "array_distinct" not in plan
    grams = sorted({t[i : i + n] for t in ("abcdefgh0", "ab0z9aab") for n in (4, 6, 8) for i in range(10 - n)})
    assert sorted(grams, key=packed.code) == grams and len({packed.code(g) for g in grams}) == len(grams)
    with pytest.raises(Exception, match="basic normalization"):
        rare.anchor_hits(s1.withColumn("name", F.lit("Straße")), others).collect()


def test_exact_methods_group_no_pairs_of_unique_ids(spark):
    rng = random.Random(8)
    rows = lambda p, n: [(f"{p}-{i % 35}", rng.choice(("", "x", "y z", None)), rng.choice(("", "1", "2", "x", None)), rng.choice(("A", "B", None))) for i in range(n)]
    one, two = rows("S1", 40), rows("S2", 40)
    want = {}
    for a in one:
        for b in two:
            for k, label in ((1, "exact_name"), (2, "exact_address")):
                if a[k] and a[k] == b[k] and a[3] and a[3] == b[3]:
                    want.setdefault((a[0], b[0]), set()).add(label)
    s1, others = (spark.createDataFrame(r, "entity_id string, name string, address string, country string") for r in (one, two))
    got = [tuple(r) for r in blocking.exact_methods(s1, others).collect()]
    assert sorted(got) == sorted((*k, "+".join(sorted(v))) for k, v in want.items()) and len(got) > 50
    # Before, every pair went through a shuffle to be grouped.
    unique = blocking.exact_methods(s1.dropDuplicates(["entity_id"]), others.dropDuplicates(["entity_id"]))
    unique.collect()
    plain = unique._jdf.queryExecution().optimizedPlan().toString()
    assert plain.startswith("Union") and plain.count("Aggregate") == 1


def test_exact_methods_deal_a_hot_key_to_tasks_in_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 8), ("TILE", 16), ("TASK", 1000)):
        monkeypatch.setattr(blocking, name, value, raising=False)
    rows = lambda p, n: [(f"{p}-{i}", "hot" if i % 10 else "", ("1", "2", "")[i // 2 % 3], "A") for i in range(n)]
    one, two = rows("S1", 150), rows("S2", 200) + [("S2-7", "hot", "2", "A")]
    want = {}
    for a in one:
        for b in two:
            for k, label in ((1, "exact_name"), (2, "exact_address")):
                if a[k] and a[k] == b[k]:
                    want.setdefault((a[0], b[0]), set()).add(label)
    s1, others = (spark.createDataFrame(r, "entity_id string, name string, address string, country string") for r in (one, two))
    got = blocking.exact_methods(s1, others).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted((*k, "+".join(sorted(v))) for k, v in want.items())
    # Before, all pairs of a name came from one task, in the order of the records.
    tasks = [r.task for r in got]
    assert max(map(tasks.count, set(tasks))) < len(tasks) / 3
    runs = sum(a.s1_id != b.s1_id for a, b in zip(got, got[1:]))
    assert runs < len(got) / 4


def test_hot_keys_are_capped_per_source(spark):
    s1 = resolve.normalized(records(spark, [("S1-1", "Same Name", "1 Road", "A")]))
    many = [(f"S2-{i}", "Same Name", "1 Road", "A") for i in range(12)] + [("S3-1", "Same Name", "1 Road", "A")]
    others = blocking.targets(resolve.normalized(records(spark, many)))
    got = rare.production_candidates(s1, others, cap=2, top_k=3, exact_limit=4).collect()
    assert sorted(r["source"] for r in got) == ["S2", "S2", "S2", "S3"]
    over = {(r["kind"], r["source"]): r["overflow"] for r in blocking.exact_overflow(s1, others, 4).collect()}
    assert over == {("name", "S2"): 1, ("address", "S2"): 1, ("name_address", "S2"): 1}


PAIR = ", ".join(f"{c} string" for c in ("s1_business_name", "s1_business_address", "s1_country", "candidate_business_name", "candidate_business_address", "candidate_country"))


def test_features(spark):
    rows = [("Müller & Söhne", "12 Ring", "AT", "MULLER SOHNE", "12 Ring 3", "AT"), (None, "", "", "", None, ""), ("kiwi", "up", "MT", "zebra fox", "down", "SE")]
    got = features_16(spark.createDataFrame(rows, PAIR)).collect()
    assert got[0]["name_exact"] == 1 and got[0]["same_country"] == 1 and got[0]["address_exact"] == 0
    # "12 ring" against "12 ring 3": 7 of 7 + 9 characters in common, 7 of the longer's 9.
    assert got[0]["address_ratio"] == pytest.approx(14 / 16) and got[0]["address_length_ratio"] == pytest.approx(7 / 9)
    assert got[0]["address_partial_ratio"] == 1 and got[0]["address_token_set"] == 1 and got[0]["combined_similarity"] == pytest.approx(1.0)
    assert got[1]["same_country"] == 1 and all(got[1][f] == 0 for f in FEATURES_16 if f != "same_country")
    assert got[2]["same_country"] == 0 and got[2]["name_exact"] == 0
    why = missed_diagnostics(spark.createDataFrame([("S1-1", "S2-1", *rows[0])], "s1_id string, candidate_id string, " + PAIR)).first()
    assert why["max_name"] == 1 and why["max_address"] == 1 and "address_token_sort" not in why.asDict()


def test_batches_score_as_single_pairs_do(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abc dé", k=rng.choice((0, 2, 9, 30, 70))))
    rows = [(word(), word()) for _ in range(200)] + [(None, "x"), ("x", None)]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("s", fuzzy.all_scores(F.col("a"), F.col("b")))
    for r in df.collect():
        if r["a"] is None or r["b"] is None:
            assert all(v is None for v in r["s"])
            continue
        total = len(r["a"]) + len(r["b"])
        assert r["s"]["ratio"] == pytest.approx(200 * lcs_table(r["a"], r["b"]) / total if total else 100)
        assert r["s"]["partial_ratio"] == pytest.approx(fuzzy.partial_ratio_of(r["a"], r["b"])) and r["s"]["token_set"] == pytest.approx(fuzzy.token_set_ratio_of(r["a"], r["b"]))


def test_metrics_and_thresholds(spark):
    truth = spark.createDataFrame([("S1-5", "S2-8,S3-4"), ("S1-6", ""), ("S1-7", "S3-9"), ("S1-8", "S2-2")], "source1_entity_id string, matched_entity_ids string")
    scored = spark.createDataFrame(
        [("S1-5", "S2-8", 0.91), ("S1-5", "S3-4", 0.62), ("S1-5", "S3-5", 0.33), ("S1-6", "S2-1", 0.57), ("S1-7", "S3-9", 0.74), ("S1-7", "S2-9", 0.74)],
        "s1_id string, candidate_id string, match_probability double")
    ids = truth.select(F.col("source1_entity_id").alias("entity_id"))
    got = {r[0]: r[1] for r in pairs.select_matches(scored, ids, 0.6).collect()}
    assert got == {"S1-5": "S2-8,S3-4", "S1-6": "", "S1-7": "S2-9,S3-9", "S1-8": ""}
    curve = evaluate.threshold_sweep(scored, truth, [5, 55, 60, 75, 95])
    for r in curve.collect():
        counts = evaluate.entity_counts(truth, pairs.select_matches(scored, ids, r["percent"] / 100))
        assert evaluate.macro_f05(counts).first()["macro_f0_5"] == pytest.approx(r["macro_f0_5"])
    # At 0.6: a full match, an empty one, one of two right with nothing missed (1.25 * 0.5 / 1.125), a miss.
    assert evaluate.best_threshold(curve).first()["percent"] == 60
    assert evaluate.best_threshold(curve).first()["macro_f0_5"] == pytest.approx((1 + 1 + 1.25 * 0.5 / 1.125 + 0) / 4)
    percent, value = model.search_threshold(scored, truth)
    assert percent == 62 and value == pytest.approx((2 + 1.25 * 0.5 / 1.125) / 4)
    labels = {(r["s1_id"], r["candidate_id"]): r["label"] for r in pairs.label(scored, truth).collect()}
    assert sum(labels.values()) == 3 and labels["S1-7", "S2-9"] == 0


def test_violations(spark, sources):
    s1, s2, s3 = sources
    m = spark.createDataFrame([("S1-11", "S2-71"), ("S1-11", ""), ("S1-12", "S2-99"), ("S9", "S1-11,Q")], "source1_entity_id string, matched_entity_ids string")
    c = spark.createDataFrame([("S1-11", "S2-71,S2-71"), ("S1-12", ""), ("S1-13", ""), ("S1-14", "")], "source1_entity_id string, candidate_entity_ids string")
    codes = {(r["file"], r["code"]) for r in qa.violations(m, c, s1, s2.unionByName(s3)).collect()}
    assert codes == {("matching", x) for x in ("duplicate_s1", "bad_s1_prefix", "missing_s1", "extra_s1", "unknown_target", "self_match", "bad_listed_prefix", "match_not_candidate")} | {("candidates", "duplicate_listed_id")}
    with pytest.raises(ValueError):
        qa.require_none(qa.violations(m, c, s1), "violations")


def test_split_and_model(spark, tmp_path):
    rows = [(f"S1-{i}", f"S2-{i}", float(i % 2), float(i % 7), i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "s1_id string, candidate_id string, name_ratio double, noise double, label int")
    fitted = model.train(df, classifier=model.build_classifier(3, 2, 0.3))
    got = model.score(fitted, df).collect()
    assert all((r["match_probability"] > 0.5) == bool(r["label"]) for r in got)
    assert model.importance(fitted, spark).first()["feature"] == "name_ratio"
    with pytest.raises(ValueError):
        model.train(df, validation=df)
    ids = spark.createDataFrame([(f"S1-{i}", "A" if i % 4 else "B") for i in range(40)], "entity_id string, country string")
    split = {(r["country"], r["split"]): r["n"] for r in model.entity_split(ids).groupBy("country", "split").agg(F.count("*").alias("n")).collect()}
    assert split == {("A", "validation"): 6, ("A", "train"): 24, ("B", "validation"): 2, ("B", "train"): 8}


def test_tsv_round_trip_and_index_reuse(spark, sources, tmp_path):
    s1, s2, s3 = sources
    tables.write_tsv(s1, f"{tmp_path}/s1", quote=True)
    assert sorted(tables.read_records(spark, f"{tmp_path}/s1", "S1-").collect()) == sorted(s1.collect())
    meta = resolve.build_index(spark, [s2, s3], f"{tmp_path}/index")
    assert resolve.build_index(spark, [s2, s3], f"{tmp_path}/index") == meta
    with pytest.raises(ValueError):
        resolve.build_index(spark, [s2], f"{tmp_path}/index")
    assert resolve.load_index(spark, f"{tmp_path}/index")[0].count() == 5


def test_cosine_prefix_loses_nothing(spark):
    names = ["alpha trading co", "alpha trade", "beta works", "betta works ltd", "gamma", ""]
    s1 = spark.createDataFrame([(f"S1-{i}", n, "", "A") for i, n in enumerate(names)], "entity_id string, name string, address string, country string")
    others = spark.createDataFrame([(f"S2-{i}", n, "", "A") for i, n in enumerate(reversed(names))], s1.schema)
    w = tfidf.weights(tfidf.corpora(s1, others, ("name",)))
    got = {(r["s1_id"], r["candidate_id"]): r["score"] for r in tfidf.cosine_pairs(w).collect()}
    rows = [r.asDict() for r in w.collect()]
    full = {}
    for a in rows:
        for b in rows:
            if a["side"] == "s1" and b["side"] == "t" and a["gram"] == b["gram"]:
                key = (a["entity_id"], b["entity_id"])
                full[key] = full.get(key, 0) + a["w"] * b["w"]
    assert got == pytest.approx({k: v for k, v in full.items() if v >= 0.25})


def test_neighbours_in_blocks_are_the_best_of_all_pairs(spark, monkeypatch):
    from pyspark.sql import Window

    from kindred.operators import neighbours

    rng = random.Random(8)
    words = ["trading", "co", "Ärger", "b", "日本語", "🦊x", "alder", "birch7", "elm", "fir", *("".join(rng.choices("aeioubdg", k=rng.randint(1, 5))) for _ in range(40))]
    texts = [None, "", " ", "co", "trading  co", *(" ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(50))]
    rows = lambda p, n: [(f"{p}-{i % (n - 5)}", rng.choice(texts), rng.choice(texts), rng.choice(["A", "A", "B", None])) for i in range(n)]  # noqa: E731  some ids repeat
    schema = "entity_id string, name string, address string, country string"
    s1 = spark.createDataFrame([*rows("S1", 60), (None, "trading co", "elm", "A"), ("S1-x", "fir", "fir", "C")], schema)
    others = spark.createDataFrame([*rows("S2", 60), *rows("S3", 40), *((f"S2-c{i}", "co trading", "elm", "A") for i in range(20)), (None, "co", "fir", "A")], schema)
    plain = tfidf.cosine_pairs(tfidf.weights(tfidf.corpora(s1, others)), 0.25, None)
    turn = Window.partitionBy("country", "source", "field", "s1_id").orderBy(F.desc(F.round("score", 12)), "candidate_id")
    plain = plain.withColumn("turn", F.row_number().over(turn))
    told = lambda d: {tuple(r[c] for c in ("country", "source", "field", "s1_id", "candidate_id")): r["score"] for r in d.collect()}
    for top_n, least, most, held, dense in ((7, 2048, 32768, 4_000_000, 256), (3, 11, 13, 50, 4)):
        for name, value in (("LEAST", least), ("S1_BLOCK", max(least, 11)), ("TARGET_BLOCK", most), ("HELD", held), ("DENSE", dense)):
            monkeypatch.setattr(neighbours, name, value)
        want = told(plain.where(F.col("turn") <= top_n))
        assert len(want) > 200
        assert told(neighbours.neighbours(s1, others, top_n=top_n)) == pytest.approx(want)
    assert not neighbours.neighbours(s1.limit(0), others).collect() and not neighbours.neighbours(s1, others.limit(0)).collect()


def test_ranked_candidates_make_no_gram_pairs(spark, monkeypatch):
    schema = "entity_id string, name string, address string, country string"
    s1 = spark.createDataFrame([("S1-1", "alder works", "4 mill lane", "A"), ("S1-2", "birch trade", "9 quay", "A"), ("S1-3", "", "4 mill lane", "A")], schema)
    others = spark.createDataFrame([("S2-1", "alder work", "4 mill lane", "A"), ("S2-2", "elm", "14 mill", "A"), ("S3-1", "birch trade", "9 quays", "A"), ("S3-2", "birch", "4 mill lane", "B")], schema)
    best = {}
    for r in tfidf.cosine_pairs(tfidf.weights(tfidf.corpora(s1, others)), 0.1, None).collect():
        if r["score"] >= (0.1 if r["field"] == "address" else 0.25):
            best[r["s1_id"], r["candidate_id"]] = max(r["score"], best.get((r["s1_id"], r["candidate_id"]), 0))
    best["S1-2", "S3-1"] = 1.0  # the exact name
    monkeypatch.setattr(tfidf, "weights", None)  # a row for each gram of each record
    got = tfidf.candidates(s1, others, address_bound=0.1).collect()
    assert {(r["source1_entity_id"], r["candidate_entity_id"]): r["retrieval_score"] for r in got} == pytest.approx(best)


def test_document_view_reads_whole_texts(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from kindred.plans.views import DOCUMENTS, view

    rows = [(0, "first\nsecond\n\nfourth é\nlast", "en"), (3, "only", "en"), (6, "\nrest\n", "fr"), (9, "", "en"), (12, None, "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = {"S1-0": ("first", "second\n\nfourth é\nlast"), "S1-3": ("only", ""), "S1-6": ("", "rest\n"), "S1-9": ("", ""), "S1-12": (None, None)}
    got = view(spark, str(tmp_path), DOCUMENTS["s1"]).collect()
    assert {r["entity_id"]: (r["business_name"], r["business_address"]) for r in got} == want
    with duckdb.connect() as con:
        con.execute("create table documents (doc_id bigint, text varchar, lang varchar)")
        con.executemany("insert into documents values (?, ?, ?)", rows)
        assert {r[0]: r[1:3] for r in con.execute(DOCUMENTS["s1"]).fetchall()} == want


def test_lenient_reading_names_the_bad_rows(spark, tmp_path):
    text_ = "\ufeffsource1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\n\nS1-2\nS1-3\ta\tb\nS1-4\t\nS1-5\t\"q\tx\"\n"
    (tmp_path / "m.tsv").write_text(text_, encoding="utf-8")
    good, errors = tables.read_tsv_lenient(spark, f"{tmp_path}/m.tsv", tables.MATCHING)
    assert sorted(map(tuple, good.collect())) == [("S1-1", "S2-1"), ("S1-4", ""), ("S1-5", "q\tx")]
    assert sorted((r["number"], r["reason"]) for r in errors.collect()) == [(4, "expected 2 fields, found 1"), (5, "expected 2 fields, found 3")]
    other = tables.read_tsv_lenient(spark, f"{tmp_path}/m.tsv", tables.CANDIDATES)[1]
    assert "header differs" in {r["reason"] for r in other.collect()}
    assert [tuple(r) for r in tables.read_lines(spark, f"{tmp_path}/m.tsv").orderBy("source1_entity_id").collect()][:2] == [("S1-1", "S2-1"), ("S1-2", "")]
    assert {r[0] for r in tables.first_column_ids(spark, f"{tmp_path}/m.tsv").collect()} == {"S1-1", "S1-2", "S1-3", "S1-4", "S1-5"}
    assert tables.header_of(spark, f"{tmp_path}/m.tsv") == list(tables.MATCHING)
    df = spark.createDataFrame([(i,) for i in (3, 1, 2)], "row_idx long")
    assert [r[0] for r in tables.head(df, 2).collect()] == [1, 2]


def test_tracker_rules_and_files(spark, tmp_path):
    base = dict.fromkeys(reports.TRACKER, "")
    row = lambda **x: tuple((base | {"experiment_id": "e1", "date": "2026-03-01", "model_name": "m", "status": "done"} | x)[c] for c in reports.TRACKER)
    frame = lambda *rows: spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in reports.TRACKER))
    sent = {"submission_number_for_day": "1", "submission_file": "s", "candidate_file": "c", "validator_status": "pass"}
    fine = frame(row(), row(experiment_id="e2", **sent))
    assert reports.tracker_violations(fine).count() == 0
    bad = frame(row(**sent), row(**sent), row(experiment_id="e3", **(sent | {"submission_number_for_day": "9", "validator_status": "", "candidate_file": ""})), row(experiment_id="e4", status=""))
    assert {r["rule"] for r in reports.tracker_violations(bad).collect()} == {"duplicate_id", "repeated_number", "bad_number", "validator_not_passed", "missing_file_name", "missing_field"}
    many = frame(*(row(experiment_id=f"x{i}", **(sent | {"submission_number_for_day": str(i)})) for i in range(1, 7)))
    assert "too_many_on_day" in {r["rule"] for r in reports.tracker_violations(many).collect()}
    tables.append_csv(reports.add_experiment(fine, frame(row(experiment_id="e5"))), f"{tmp_path}/tracker")
    tables.append_csv(fine, f"{tmp_path}/tracker")
    assert tables.read_csv(spark, f"{tmp_path}/tracker", reports.TRACKER).count() == 3
    with pytest.raises(ValueError, match="duplicate_id"):
        reports.add_experiment(fine, frame(row()))
    with pytest.raises(ValueError, match="missing"):
        tables.read_csv(spark, f"{tmp_path}/tracker", ("no_such",))
    assert reports.cross_agreement({"source1_rows": 3, "zero_matches": 1}, {"source1_rows": 3, "zero_matches": 2}) == ["zero_matches"]
    assert reports.country_map(spark.createDataFrame([("A",), ("A",), (None,)], "country string")).first()["countries"] == {"": 1, "A": 2}


def test_packages_and_provenance(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("one")
    (tmp_path / "in" / "b.tsv").write_text("two")
    made = tables.write_package(f"{tmp_path}/p.zip", {"a.tsv": f"{tmp_path}/in/a.tsv", "b.tsv": f"{tmp_path}/in/b.tsv"}, ("a.tsv",))
    assert made["a.tsv"] == tables.sha256_of(f"{tmp_path}/in/a.tsv")["sha256"]
    assert {r["sha256"] for r in tables.file_fingerprints(spark, f"{tmp_path}/in").collect()} == set(made.values())
    with pytest.raises(ValueError, match="missing"):
        tables.inspect_package(f"{tmp_path}/p.zip", ("c.tsv",))
    first = tables.provenance(spark, model=f"{tmp_path}/in")
    tables.require_same_provenance(first, tables.provenance(spark, model=f"{tmp_path}/in"))
    (tmp_path / "in" / "b.tsv").write_text("changed")
    with pytest.raises(ValueError, match="model"):
        tables.require_same_provenance(first, tables.provenance(spark, model=f"{tmp_path}/in"))
    tables.write_report({"n": 1}, f"{tmp_path}/r.json")
    assert tables.read_report(f"{tmp_path}/r.json") == {"n": 1}
    tables.remove_report(f"{tmp_path}/r.json")
    assert tables.read_report(f"{tmp_path}/r.json") is None
    one = spark.createDataFrame([("a", None), ("b", "")], "x string, y string")
    mark = lambda df: tables.fingerprint(df).first()
    assert mark(one) == mark(one.repartition(3)) and mark(one) != mark(one.fillna("")) and mark(one)["rows"] == 2


def test_sql_functions_and_contract(spark):
    fuzzy.register(spark)
    got = spark.sql("select fuzz_ratio('abcd', 'abxd') r, fuzz_partial_ratio('bc', 'abcd') p, fuzz_token_sort_ratio('b a', 'a b') s, fuzz_token_set_ratio('a b', 'a') t, normalize_text(' Ärzte-Haus ') n").first()
    assert tuple(got) == (75.0, 100.0, 100.0, 100.0, "arzte haus")
    table = spark.createDataFrame([("S1-1", "S2-1", 1), ("S1-1", "S2-1", 0), ("S1-2", "X", 0), (None, "S3-1", 0), ("S1-3", "S3-3", 7)], "s1_id string, candidate_id string, label int")
    assert {r["code"] for r in qa.contract_violations(table).collect()} == {"duplicate_pair", "bad_prefix", "null_id", "bad_label"}
    assert model.overlap(table.where("label = 1"), table.where("label = 0")).count() == 1
    rows = spark.createDataFrame([(0, "S1-1"), (1, "S1-2")], "row_idx long, source1_entity_id string")
    s1 = rows.withColumnRenamed("source1_entity_id", "entity_id")
    assert qa.lockstep(s1, rows, rows).count() == 0 and qa.lockstep(s1, rows, rows.where("row_idx = 0")).count() == 1


def test_run_stream_and_official_rules(spark, sources, tmp_path):
    from kindred.streaming.infer import match_stream

    s1, s2, s3 = sources
    for i, df in enumerate((s1, s2, s3), 1):
        tables.write_tsv(df.coalesce(1), f"{tmp_path}/data/source{i}.tsv", quote=True)
    rows = [("S1-%d" % i, "S2-%d" % i, *(float((i + k) % 2) if k == 0 else 0.1 for k in range(len(FEATURES_16))), (i + 0) % 2) for i in range(40)]
    fitted = model.train(spark.createDataFrame(rows, "s1_id string, candidate_id string, " + ", ".join(f"{f} double" for f in FEATURES_16) + ", label int"), list(FEATURES_16), model.build_classifier(2, 2, 0.3))
    model.save(fitted, f"{tmp_path}/model")
    with pytest.raises(ValueError, match="schema"):
        model.load(f"{tmp_path}/model", ("other",))
    fitted = model.load(f"{tmp_path}/model")
    report = resolve.run(spark, f"{tmp_path}/data", f"{tmp_path}/index", f"{tmp_path}/out", fitted, model_path=f"{tmp_path}/model")
    assert report["qa"]["passed"] and report["qa"]["source1_rows"] == 4 and tables.read_report(f"{tmp_path}/out/strict_qa.json")["source1_rows"] == 4
    assert resolve.official(spark, f"{tmp_path}/data", f"{tmp_path}/out", f"{tmp_path}/index").count() == 0
    assert resolve.candidate_table(spark, f"{tmp_path}/data", f"{tmp_path}/index", "rare").count() == report["qa"]["candidate_pairs"]
    with pytest.raises(ValueError, match="model"):
        resolve.run(spark, f"{tmp_path}/data", f"{tmp_path}/index", f"{tmp_path}/out", None, stage="validate")
    assert tables.read_report(f"{tmp_path}/out/strict_qa.json") is None
    s1.write.parquet(f"{tmp_path}/stream")
    stream = spark.readStream.schema(s1.schema).parquet(f"{tmp_path}/stream")
    match_stream(stream, f"{tmp_path}/index", fitted, f"{tmp_path}/matched", f"{tmp_path}/state").awaitTermination(120)
    batch = tables.read_tsv(spark, f"{tmp_path}/out/matching_results", tables.MATCHING)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/matched").select(*tables.MATCHING).collect())) == sorted(map(tuple, batch.collect()))
