"""Word arrays, repetition rules, quality model, toxicity and line dedup against plain versions."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillmetrics.llm import line_dedup, quality_model, repetition, toxicity
from tillmetrics.llm.arrays import text_blocks, window_hashes

SPACES = r"[^\x20\x09-\x0D]+"
EDGE = [None, "", " ", "\n\n", "word", "a b c d", "é" * 50, "x " * 3000, "a b c d e f g h i j " * 300]


def plain_measures(text, least):
    text = text or ""
    words = re.findall(SPACES, text)
    n = len(words)

    def windows(k):
        return collections.Counter(tuple(words[i : i + k]) for i in range(n - k + 1))

    def cover(k):
        counts, inside = windows(k), set()
        for i in range(n - k + 1):
            if counts[tuple(words[i : i + k])] > 1:
                inside.update(range(i, i + k))
        return len(inside)

    longest = 0
    while any(c > 1 for c in windows(longest + 1).values()):
        longest += 1
    lines = [x for x in text.split("\n") if re.search(SPACES, x)]
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        cover(5),
        cover(least),
        longest,
    )


def measured(values, least):
    out = []
    for _, _, block in text_blocks(pa.array(values, pa.string())):
        m = repetition.measure(block, least)
        out += [tuple(int(m[k][i]) for k in m) for i in range(block.rows)]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \né#\t", max_size=60), min_size=1, max_size=6), st.integers(1, 6))
def test_measures_match_brute_force(values, least):
    assert measured(values, least) == [plain_measures(v, least) for v in values]


def test_sliced_arrays_and_blocks():
    values = [f"t{i} " * (i % 7) for i in range(50)]
    column = pa.array(values).slice(13, 20)
    got = [len(block.words()[0]) for _, _, block in text_blocks(column)]
    assert sum(got) == sum(len(v.split()) for v in values[13:33])


def test_window_hashes_of_short_rows():
    hashes = np.arange(1, 10, dtype=np.uint64)
    bounds = np.array([0, 0, 3, 9])
    out, starts = window_hashes(hashes, bounds, 5)
    assert starts.tolist() == [0, 0, 1, 3] and len(set(out.tolist())) == 3


def test_repetition_rules_edges(texts):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(3, EDGE[3]), (None, "a b")]
    got = repetition.repetition_rules(texts(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_measures(EDGE[r.doc_id] if r.doc_id is not None else "a b", 8)
        assert tuple(r)[1:8] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    assert repetition.repetition_rules(texts([])).count() == 0


def test_repetition_verdict_and_filter(texts):
    words = [f"w{i}" for i in range(600)]
    passage = " ".join(words[:51])
    rows = [(1, " ".join(words)), (2, " ".join(words) + " " + passage), (3, "too short")]
    kept = repetition.drop_repetitive(texts(rows))
    assert [r.doc_id for r in kept.collect()] == [1]
    assert kept.columns == texts(rows).columns
    long = {r.doc_id: r.longest_repeat for r in repetition.repetition_rules(texts(rows)).collect()}
    assert long == {1: 0, 2: 51, 3: 0}


def test_each_repetition_limit_rejects_alone(texts):
    words = [f"w{i}" for i in range(600)]
    # Three repeats of 12 words: 72 of 636 words, over a tenth; none is long.
    many = words + words[:12] + ["x"] + words[20:32] + ["y"] + words[40:52]
    # One of 28 in 628 words: 56 words, below a tenth, but over 4 % of the text.
    one = words + words[100:128] + ["z"]
    rows = [(1, " ".join(words)), (2, " ".join(many)), (3, " ".join(one)), (4, " ".join(words + words[:8])), (5, "short")]
    rules = repetition.repetition_rules(texts(rows))
    got = {r.doc_id: r for r in rules.collect()}
    assert {i for i, r in got.items() if r.kept} == {1, 4}
    assert {i for i, r in got.items() if r.base_failed} == {5}
    assert sorted(r.doc_id for r in repetition.drop_repetitive(texts(rows)).collect()) == [1, 4]
    counts = repetition.rejections(rules).first().asDict()
    assert counts == {"rows": 5, "base": 1, "covered": 1, "longest": 1, "covered_only": 1, "longest_only": 1}


def _labelled(n):
    rng = random.Random(3)
    good = [f"word{i} " for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        body = [rng.choice(good) for _ in range(rng.randint(40, 120))]
        if bad:
            body = [w.upper().strip() + "!!# " for w in body]
        toxic = i % 5 == 0
        if toxic:
            for w in rng.sample(["vile ", "nasty ", "awful ", "horrid "], rng.randint(2, 4)):
                body.insert(rng.randrange(len(body)), w)
        docs.append((i, "".join(body)))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def test_quality_model(spark, texts):
    docs, labels = _labelled(400)
    known = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = docs + [(1000 + i, t) for i, t in enumerate(EDGE)] + [docs[0], (None, "x")]
    got = quality_model.quality_scores(texts(rows), known).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    again = {r.doc_id: r.score for r in quality_model.quality_scores(texts(rows).coalesce(1), known).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in got if r.doc_id is not None)


@pytest.mark.parametrize(("label", "score"), [(None, 0.5), (1, 1.0), (0, 0.0)])
def test_quality_model_without_both_classes(spark, texts, label, score):
    known = spark.createDataFrame([(1, label), (2, label)], "doc_id long, quality int")
    got = quality_model.quality_scores(texts([(1, "a b"), (2, None)]), known).collect()
    assert [r.score for r in got] == [score, score]
    assert quality_model.quality_scores(texts([]), known).count() == 0


def test_held_out_rule(spark):
    import zlib

    ids = spark.range(50).select("id", quality_model.held_out(__import__("pyspark").sql.functions.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in ids.collect())


def test_toxicity(spark, texts):
    docs, labels = _labelled(400)
    known = spark.createDataFrame([*labels, (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    train = texts([d for d in docs if d[0] % 3])
    model = toxicity.fit(train, known, fit_rows_per_class=200)
    assert (np.diff(model.thresholds) > 0).all()
    # Rows that share an id teach once.
    again = toxicity.fit(train.unionByName(train).unionByName(train), known, fit_rows_per_class=200)
    assert (again.keys == model.keys).all() and np.allclose(again.weights, model.weights, atol=1e-6)
    rows = docs + [(1000 + i, t) for i, t in enumerate(EDGE)] + [(None, "vile nasty"), docs[0]]
    got = toxicity.severity(texts(rows), model).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.doc_id in truth and r.doc_id % 3 == 0]
    assert np.mean([r.toxic == bool(truth[r.doc_id]) for r in held]) > 0.95
    assert all(0 <= r.expected_severity <= 3 for r in got)
    few = {r.doc_id: r.expected_severity for r in got}
    worse = toxicity.severity(texts([(1, "vile"), (2, "vile nasty awful horrid")]), model).collect()
    by = {r.doc_id: r.expected_severity for r in worse}
    assert by[2] > by[1] > few[1001]
    left = toxicity.drop_toxic(texts(rows), model)
    toxic = sorted((r.doc_id or -1) for r in got if not r.toxic)
    assert sorted((r.doc_id or -1) for r in left.collect()) == toxic
    assert toxicity.severity(texts([]), model).count() == 0


def test_toxicity_without_toxic_rows(spark, texts):
    known = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(texts([(1, "vile")]), known)
    assert not toxicity.severity(texts([(1, "vile"), (2, None)]), model).filter("toxic").count()


def plain_line_dedup(rows, min_sites, keep_first):
    sites, first = collections.defaultdict(set), {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\r")
            if key:
                if site is not None:
                    sites[key].add(site)
                if i is not None and (key not in first or i < first[key]):
                    first[key] = i
    out = []
    for i, text, _ in rows:
        if text is None:
            out.append((i, None))
            continue
        lines = []
        for line in text.split("\n"):
            key = line.strip(" \t\r")
            wide = key and len(sites[key]) >= min_sites
            if not wide or (keep_first and first.get(key) == i):
                lines.append(line)
        out.append((i, "\n".join(lines)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_first", [True, False])
def test_line_dedup_matches_brute_force(texts, keep_first):
    rng = random.Random(5)
    common = [f"shared line {i}" for i in range(30)]
    rows = [
        (i, "\n".join(rng.choice(common) + " " * rng.randint(0, 1) if rng.random() < 0.5 else f"own {i} {j}" for j in range(6)), f"s{rng.randint(0, 14)}")
        for i in range(120)
    ]
    rows += [(200, None, "s1"), (201, "", "s2"), (202, "\n\n", None), (None, "shared line 1", "s3"), rows[0]]
    got = line_dedup.remove_boilerplate(texts(rows), 10, keep_first, report="info")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == plain_line_dedup(rows, 10, keep_first)
    assert got.columns == [*texts(rows).columns, "info"]
    assert all(r.info.n_removed == (0 if r.text is None else r.info.n_lines - len(r.text.split("\n"))) or not r.text for r in got.collect())
    assert line_dedup.remove_boilerplate(texts([])).count() == 0


def test_passages_on_few_sites_and_clean_documents(texts):
    def passage(name):
        return " ".join(f"{name}{i}" for i in range(55))

    # A passage in 12 documents on 6 sites, one in 30 on 9; copies of four documents stay.
    rows = [(i, f"own {i}\n{passage('p')}", f"s{i % 6}") for i in range(12)]
    rows += [(100 + i, f"own {100 + i}\n{passage('q')}", f"s{i % 9}") for i in range(30)]
    rows += [(200 + i, f"{passage('r')}\nclean", f"s{i}") for i in range(4)]
    got = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(texts(rows)).collect()}
    before = {i: t for i, t, _ in rows}
    changed = [i for i in got if got[i] != before[i]]
    assert sorted(changed) == [*range(1, 12), *range(101, 130)]
    assert all(got[i] == f"own {i}" for i in changed)


def test_line_dedup_near_threshold_is_exact(texts):
    rows = [(i, "nine sites\n" * 2 + "ten sites", f"s{i % 9}") for i in range(90)] + [(90, "ten sites", "s9")]
    got = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(texts(rows), 10, keep_first=False).collect()}
    assert got[5] == "nine sites\nnine sites" and got[90] == ""
