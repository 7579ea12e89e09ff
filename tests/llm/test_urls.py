"""URL verdicts against a plain version."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tillmetrics.llm import url_filter
from tillmetrics.llm.queries import URL_RULES
from tillmetrics.llm.url_filter import TELLING, UNIT, Rule, best_split, judge

SCHEMA = "page_id long, url string, html string, host string, word string, n long, token int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3, 4) for r in rows], SCHEMA).repartition(3)


def plain_split(name, counts, total):
    """The best of all splits, one by one."""
    best = None
    for k in range(len(name)):
        for at in itertools.combinations(range(1, len(name)), k):
            words = [name[a:b] for a, b in zip((0, *at), (*at, len(name)))]
            if max(map(len, words)) > url_filter.WORD_LETTERS:
                continue
            p = math.prod((counts[w] if counts[w] else 10 / 10 ** len(w)) / total for w in words)
            if best is None or p > best[0]:
                best = (p, words)
    return best[1]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_judge(rows, rules):
    parts = [plain_parts(r[1]) for r in rows]
    hosts = sorted({h for h, _ in parts})
    counts = Counter()
    for _, _, html in rows:
        text = re.sub(r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ", html or "")
        counts.update(w for w in re.findall(r"[^\W\d_]+", text.lower()) if re.fullmatch("[a-z]{1,24}", w))
    for h in hosts:
        for label in h.split("."):
            if "-" in label:
                counts.update(w for w in re.findall("[a-z]+", label) if len(w) <= 24)
    total = max(sum(counts.values()), 1)
    words = {h: [w for n in re.findall("[a-z]{1,63}", h) for w in plain_split(n, counts, total)] for h in hosts}
    bad = {h: any(w in TELLING for w in words[h]) for h in hosts}
    seen = {True: Counter(), False: Counter()}
    trails = defaultdict(set)
    for h, p in parts:
        trails[h].update(re.findall("[a-z]+", re.sub("[A-Z]", lambda m: m[0].lower(), p)))
    for h in hosts:
        seen[bad[h]].update([f"h:{w}" for w in words[h]] + [f"p:{w}" for w in trails[h]])
    kinds = len(set(seen[True]) | set(seen[False]))
    n_bad, n_good = sum(seen[True].values()), sum(seen[False].values())
    both = n_bad and n_good
    s = url_filter.SMOOTHING

    def weight(t):
        if not both:
            return 0
        return round(
            (math.log((seen[True][t] + s) / (n_bad + s * kinds)) - math.log((seen[False][t] + s) / (n_good + s * kinds))) * UNIT
        )

    n = sum(bad.values())
    prior = round(math.log(n / (len(hosts) - n)) * UNIT) if 0 < n < len(hosts) else -UNIT
    out = []
    for (page_id, _, _), (h, p) in zip(rows, parts):
        tokens = [f"h:{w}" for w in words[h]]
        tokens += [f"p:{w}" for w in re.findall("[a-z]+", re.sub("[A-Z]", lambda m: m[0].lower(), p))]
        score = prior + sum(map(weight, tokens))
        fits = []
        for r in rules:
            domain, rest = r.text.split("/", 1)
            if (h == domain or h.endswith("." + domain)) and p.startswith("/" + rest):
                fits.append(r)
        rule = max(fits, key=lambda r: len(r.text), default=None)
        verdict = rule.verdict if rule else ("block" if score > 0 else "allow")
        out.append((page_id, h, p, rule.text if rule else None, verdict, score, words[h]))
    return out


def test_split_is_the_best_of_all():
    rng = random.Random(3)
    for _ in range(200):
        counts = Counter({"".join(rng.choices("abc", k=rng.randint(1, 4))): rng.randint(1, 90) for _ in range(12)})
        total = sum(counts.values())
        name = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        known = {
            (i, j - i): counts[name[i:j]] for i in range(len(name)) for j in range(i + 1, len(name) + 1) if counts[name[i:j]]
        }

        def chance(words):
            return sum(math.log((counts[w] or 10 / 10 ** len(w)) / total) for w in words)

        got = best_split(name, known, total)
        assert "".join(got) == name
        assert chance(got) == pytest.approx(chance(plain_split(name, counts, total)))
    assert best_split("", {}, 0) == []


ROWS = [
    *[(i, f"https://www.casino-win.example.com/en/{i}.html", "<p>casino win cheap pills bet</p>") for i in range(4)],
    *[(10 + i, f"http://cheapcasino.shop.example.org/de/{i}?x=/fr/", "<b>the cheap the farm</b>") for i in range(3)],
    *[(20 + i, f"http://thefarm.example.org/fr/page{i}", "<script>casino()</script>the farm news the") for i in range(5)],
    *[(30 + i, f"http://News.Example.NET/{p}", "news the farm") for i, p in enumerate(["en/1", "de/1", "EN/x", "", "en"])],
    (40, "http://example.com/de/a", None),
    (41, "http://notexample.com/de/a", "é<i>été the</i>"),
    (42, "http://fr.org/fr/é#x://y", "the"),
    (43, None, "the farm"),
    (43, None, "the farm"),
    (44, "", None),
    (45, "no scheme/net/", ""),
    (46, "://", None),
    (47, "x://" + "q" * 200 + ".net:80/" + "zz/" * 50, "qq qqq " + "q" * 70),
    (None, "ftp://net/", "x"),
    (48, "ftp://net", "x"),
    (49, "http://a\nb.org/fr/\nq", "x"),
    (50, "http://.net/", "x"),
]


def same(got, want):
    key = lambda r: (str(r[0]), r[1], r[2])
    got = sorted((tuple(r) for r in got), key=key)
    want = sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] * UNIT == pytest.approx(w[5], abs=20)
        assert list(g[6]) == w[6]


def test_matches_the_plain_version(spark, monkeypatch):
    # The plain split tries all ways, so names must be short.
    monkeypatch.setattr(url_filter, "NAME_LETTERS", 12)
    rows = [r for r in ROWS if r[0] != 47]
    same(judge(table(spark, rows), URL_RULES).collect(), plain_judge(rows, URL_RULES))


def test_long_names_and_many_slices(spark):
    out = {r.page_id: r for r in judge(table(spark, ROWS), URL_RULES).collect() if r.page_id is not None}
    assert "".join(out[47].host_words) == "q" * 200 + "net"
    assert max(map(len, out[47].host_words)) <= url_filter.WORD_LETTERS
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sliced = judge(table(spark, ROWS), URL_RULES).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(repr, sliced)) == sorted(map(repr, judge(table(spark, ROWS), URL_RULES).collect()))


def test_learns_from_telling_hosts(spark):
    rows = [(i, f"http://{a}{b}.example.com/x", "casino lucky farm garden") for i, (a, b) in enumerate(
        [("casino", "lucky")] * 1 + [("casino-", "lucky")] * 3 + [("farm", "garden")] * 9)]
    rows += [(100 + i, f"http://casino{i}.lucky.example.com/x", None) for i in range(6)]
    rows += [(200 + i, f"http://garden{i}.example.com/x", None) for i in range(6)]
    rows += [(300, "http://luckylucky.example.com/x", None), (301, "http://gardengarden.example.com/x", None)]
    out = {r.page_id: r.verdict for r in judge(table(spark, rows)).collect()}
    assert out[300] == "block" and out[301] == "allow" and out[0] == "block" and out[12] == "allow"


def test_without_examples_all_is_allowed(spark):
    rows = [(i, f"http://farm{i}.example.com/x", "farm") for i in range(5)]
    assert {r.verdict for r in judge(table(spark, rows)).collect()} == {"allow"}
    assert judge(table(spark, rows), [Rule("block", "com/")]).filter("verdict = 'block'").count() == 5
    assert judge(table(spark, []), URL_RULES).collect() == []
