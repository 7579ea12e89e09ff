"""The pipeline's stages against plain versions on a small input."""

import random

import corpus_pipeline
from test_similarity import plain_components, shingles
from test_text_operators import plain_line_dedup, plain_measures


def _corpus():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    docs, labels = [], []
    for i in range(260):
        lines = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(rng.randint(1, 6))]
        if i % 6 == 0:
            lines.append("all rights reserved on every site")
        toxic = i % 9 == 0
        if toxic:
            lines.append(" ".join(rng.sample(["vile", "nasty", "awful", "horrid", "wretched"], 3)))
        if i % 20 == 3:
            lines = ["again and again and again"] * 10
        docs.append((i, "\n".join(lines), "en", f"s{i % 13}", 0))
        labels.append((i, 1, int(toxic)))
    docs += [(300 + k, docs[k][1].replace("w1 ", "w2 "), "en", "s1", 0) for k in range(0, 100, 7)]
    docs += [(400, None, "en", "s1", None), (401, "", None, None, 0)]
    return docs, labels


def test_stages(spark, tmp_path):
    docs, labels = _corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = frame
        if name != "packing":
            assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = {n: [tuple(r) for r in f.collect()] for n, f in seen.items() if n != "packing"}
    toxic = {i for i, _, t in labels if t and i % 20 != 3}
    kept = {r[0] for r in rows["toxicity"]}
    assert len(toxic & kept) <= 1
    assert len({d[0] for d in docs if d[0] < 300} - toxic - kept) <= 2

    def passes(text):
        m = plain_measures(text, 8)
        return m[0] >= 10 and 100 * m[4] <= 20 * m[0] and m[5] <= 0.1 * m[0] and m[6] <= min(50, max(8, 0.04 * m[0]))

    assert {r[0] for r in rows["quality_rules"]} == {r[0] for r in rows["toxicity"] if passes(r[1])}
    want = plain_line_dedup([(r[0], r[1], r[3]) for r in rows["quality_rules"]], 5, True)
    assert sorted(((r[0], r[1]) for r in rows["line_dedup"]), key=repr) == want
    assert all(r[4] == len(r[1]) for r in rows["line_dedup"])
    sets = {r[0]: shingles(r[1]) for r in rows["line_dedup"]}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    ]
    roots = plain_components(sets, links)
    assert {r[0] for r in rows["near_copies"]} == {i for i in sets if roots[i] == i}
    assert {r.doc_id for r in seen["packing"].select("doc_id").collect()} == {r[0] for r in rows["near_copies"]}


def test_run_is_the_stages(spark, tmp_path):
    docs, labels = _corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs[:60], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(frame.collect())


def test_odd_rows_pass_every_stage(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(None, long), (1, None), (2, ""), (3, long), (3, long), (4, long + " x"), (5, "a b c d e f g h i j k")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node long, _doc string, _place string"
    frame = spark.createDataFrame([(i, t, None, None, None, 7, "d", "p") for i, t in rows], schema)
    spark.createDataFrame([(5, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    want = {
        "toxicity": [None, 1, 2, 3, 3, 4, 5],
        "quality_rules": [None, 3, 3, 4, 5],
        "line_dedup": [None, 3, 3, 4, 5],
        "near_copies": [None, 3, 5],
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == [c.split()[0] for c in schema.split(", ")]
        assert sorted((r.doc_id for r in frame.collect()), key=lambda i: i or -1) == want[name]
        assert {(r.node, r._doc, r._place) for r in frame.collect()} == {(7, "d", "p")}
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {None, 3, 5}


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
