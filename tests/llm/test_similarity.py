"""Near copies of vectors and texts against all pairs."""

import random

import numpy as np
import pytest

from tillmetrics.llm import embedding_dedup, graph, jaccard_join


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    links += [(500, i) for i in range(501, 600)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame([*links, (None, 1), (9, 9)], "a long, b long")).collect()}
    nodes = {n for e in links if e[0] != e[1] for n in e}
    assert got == plain_components(nodes, [e for e in links if e[0] != e[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for label in (0, 1):
        rows += [(rng.normal(size=16), label) for _ in range(150)]
        center = rng.normal(size=16)
        rows += [(center + rng.normal(size=16) * 0.12, label) for _ in range(400)]
        rows += [(center * 1.0, label) for _ in range(20)]
    out = [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]
    n = len(out)
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] * 16, [None] + [1.0] * 15, [1.0] * 8]
    out += [(n + k, v, 0) for k, v in enumerate(odd)]
    out += [(n + 20, out[0][1], None), (None, out[0][1], 0), out[1], (n + 21, [x * 1e200 for x in out[2][1]], 0)]
    return out


def plain_vector_links(rows):
    links = []
    usable = []
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and None not in v:
            x = np.array(v)
            if np.isfinite(x).all() and x.any():
                x = x / np.abs(x).max()
                usable.append((k, i, label, x / np.linalg.norm(x)))
    for a in range(len(usable)):
        for b in range(a):
            if usable[a][2] == usable[b][2] and len(usable[a][3]) == len(usable[b][3]):
                if usable[a][3] @ usable[b][3] >= 0.98:
                    links.append((usable[a][0], usable[b][0]))
    return links


def test_embedding_dedup_matches_all_pairs(spark, vectors, monkeypatch):
    # Windows and blocks far smaller than the groups, so that both are crossed.
    monkeypatch.setattr(embedding_dedup, "WINDOW", 64)
    monkeypatch.setattr(embedding_dedup, "COUNT_BLOCK", 100)
    rows = spark.createDataFrame(
        [(*r, 1, "x") for r in vectors], "vec_id long, embedding array<double>, label int, node int, kind string"
    ).repartition(3)
    got = embedding_dedup.near_copies(rows).collect()
    assert len(got) == len(vectors)
    links = plain_vector_links(vectors)
    count = np.zeros(len(vectors), int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    ids = [r[0] for r in vectors]
    roots = plain_components({i for i in ids if i is not None}, [(ids[a], ids[b]) for a, b in links])
    want = sorted(
        ((i, int(c), roots.get(i), i == roots.get(i)) for i, c in zip(ids, count, strict=True)), key=repr
    )
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert embedding_dedup.near_copies(rows.limit(0)).count() == 0


def test_lone_pairs_in_a_narrow_cone(spark, monkeypatch):
    # Mean cosine 0.9: signs of the vectors themselves hardly split the label.
    monkeypatch.setattr(embedding_dedup, "WINDOW", 4)
    rng = np.random.default_rng(3)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    base = unit(unit(rng.normal(size=(1, 32))) * 3 + unit(rng.normal(size=(1200, 32))))
    other = rng.normal(size=(100, 32))
    other = unit(other - (other * base[:100]).sum(1, keepdims=True) * base[:100])
    partner = 0.981 * base[:100] + np.sqrt(1 - 0.981**2) * other
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(np.concatenate([base, partner]))]
    got = embedding_dedup.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    links = plain_vector_links(rows)
    assert {(i, 1200 + i) for i in range(100)} <= {(min(a, b), max(a, b)) for a, b in links}
    roots = plain_components(range(len(rows)), links)
    assert {r.vec_id: r.component_id for r in got.collect()} == roots


def test_passes_grow_with_the_data():
    few, many = (embedding_dedup.passes_needed(n, 0.98) for n in (1000, 10**9))
    assert 2 <= few < many < 200


def shingles(text, words=5):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def _texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    docs = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 150))) for _ in range(150)]
    for k in range(40):
        base = docs[k].split()
        for _ in range(rng.randint(1, 3)):
            copy = list(base)
            for _ in range(max(1, len(copy) // rng.randint(20, 60))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
    docs += [f"{passage} {d}" for d in docs[:100]]
    big = [rng.choice(vocabulary) for _ in range(200)]
    for _ in range(150):
        copy = list(big)
        for _ in range(2):
            copy[rng.randrange(200)] = rng.choice(vocabulary)
        docs.append(" ".join(copy))
    docs += [docs[0]] * 30 + [docs[0].upper(), "one", "one", "One two", None, "", " \n", "x " * 5000]
    return docs


@pytest.mark.parametrize("small", [200, 20])
def test_jaccard_join_matches_all_pairs(spark, texts, monkeypatch, small):
    # With small buckets the splitting, the leaders and the blocks all have work.
    monkeypatch.setattr(jaccard_join, "SMALL_BUCKET", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", 64 if small < 200 else 512)
    monkeypatch.setattr(jaccard_join, "COUNT_BLOCK", 60 if small < 200 else 1024)
    docs = _texts()
    rows = [(i, t) for i, t in enumerate(docs)] + [(None, docs[0])]
    sets = [shingles(t) for t in docs]
    links = []
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common * 10 >= 8 * (len(sets[a]) + len(sets[b]) - common):
                    links.append((a, b))
    count = np.zeros(len(docs), int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    roots = plain_components(range(len(docs)), links)
    got = jaccard_join.jaccard_classes(texts(rows)).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i: found[i].component_id for i in found} == roots
    assert {i: found[i].n_links for i in found} == {i: int(c) for i, c in enumerate(count)}
    first = {}
    for i, s in enumerate(sets):
        key = frozenset(s) if s else i
        assert found[i].class_id == first.setdefault(key, i)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())
    alone = [r for r in got if r.doc_id is None]
    assert [(r.n_links, r.component_id, r.kept) for r in alone] == [(0, None, True)]


def test_keep_one(spark, texts):
    docs = _texts()
    rows = [(i, t) for i, t in enumerate(docs)] + [(0, docs[0]), (None, "a"), (None, "a")]
    ids = jaccard_join.jaccard_classes(texts(rows)).filter("kept and doc_id is not null")
    left = jaccard_join.keep_one(texts(rows))
    assert left.columns == texts(rows).columns
    got = sorted(r.doc_id for r in left.collect() if r.doc_id is not None)
    assert got == sorted({r.doc_id for r in ids.collect()})
    assert left.filter("doc_id is null").count() == 2
    assert jaccard_join.keep_one(texts([])).count() == 0


def _shared_passages():
    """(texts, planted): 4,000 texts share 80 words, 20 phrases stand in 250 short texts each.

    Planted pairs have a similarity of 0.8 to 0.82: texts that hold the passage, long
    and middling texts without it, and a phrase alone with each text that adds a word to it.
    """
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(20000)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = words(80)
    docs, planted = [], []

    def pair(base, changes):
        """The text and one with words changed so far apart that each costs five windows."""
        copy = list(base)
        for c in range(changes):
            copy[len(passage) + 5 + 6 * c] = "changed" + rng.choice(vocabulary)
        a, b = shingles(" ".join(base)), shingles(" ".join(copy))
        assert 0.8 <= len(a & b) / len(a | b) <= 0.82
        docs.extend([" ".join(base), " ".join(copy)])
        planted.append((len(docs) - 2, len(docs) - 1))

    for _ in range(200):
        pair(passage + words(239), 7)
    docs += [" ".join(passage + words(240)) for _ in range(3600)]
    for _ in range(100):
        pair(words(409), 9)
        pair(words(184), 4)
    phrases = [words(8) for _ in range(20)]
    for phrase in phrases:
        at = len(docs)
        docs.extend(" ".join([*phrase, rng.choice(vocabulary) + str(k)]) for k in range(250))
        docs.append(" ".join(phrase))
        planted += [(at + k, at + 250) for k in range(250)]
    return docs, planted


def test_passages_in_thousands_of_texts(spark, monkeypatch):
    docs, planted = _shared_passages()
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in jaccard_join.jaccard_classes(rows).collect()}
    met = sum(got[a].component_id == got[b].component_id for a, b in planted)
    assert met >= 0.99 * len(planted), (met, len(planted))
    partners = np.bincount(np.array(planted).ravel(), minlength=len(docs))
    assert sum(got[i].n_links for i in range(len(docs))) >= 0.99 * partners.sum()
    assert all(got[i].n_links <= partners[i] for i in range(len(docs)))

    # The groups that are compared: how many rows each has.
    def count_rows(threshold):
        import pyarrow as pa

        return lambda table: pa.table({"a": [table.num_rows], "b": [-1]})

    profiles = jaccard_join._profiles(rows, 5)
    folder = jaccard_join.scratch_path(spark, "groups")
    profiles.withColumnRenamed("doc_id", "rep").write.parquet(f"{folder}/reps")
    monkeypatch.setattr(jaccard_join, "_bucket_edges", count_rows)
    edges = jaccard_join.candidate_edges(spark.read.parquet(f"{folder}/reps"), 0.8, folder)
    sizes = [r.a for r in edges.filter("b = -1").collect()]
    assert sum(sizes) > 10000
    assert max(sizes) < 3 * jaccard_join.LOT_ROWS, sorted(sizes)[-5:]


def test_split_levels_reach_their_target():
    bounds = jaccard_join.child_bounds(0.8)
    assert len(bounds) == jaccard_join.TOKENS
    for size, bound in enumerate(bounds, 1):
        assert 0 < bound <= 1
        assert jaccard_join.split_miss(size, bound, 0.8) <= jaccard_join.MISS
