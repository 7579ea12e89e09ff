"""URL verdicts: host rules, host names split into words, naive Bayes over words and path tokens.

A host's runs of letters are split by a unigram Viterbi. The word counts come from the
visible text of all pages and from hyphenated host labels; they are joined to the
substrings of the distinct names, so the dictionary may grow with the pages. Hosts that
hold a telling word are the examples of the block class; a multinomial naive Bayes then
weighs every host word and path token. Weights are whole millionths, so that sums do not
depend on their order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import with_lookups
from ..session import scratch_path
from .ship import ship

#: A DNS label has at most 63 characters; longer runs of letters are split piece by piece.
NAME_LETTERS = 63
#: Longest word of the dictionary.
WORD_LETTERS = 24
#: Weights are kept as whole numbers of this fraction.
UNIT = 1_000_000
#: Added to every count of a token in a class.
SMOOTHING = 0.1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words whose presence in a host makes it an example of the block class.
TELLING = (
    "adult", "ads", "adserver", "bet", "bets", "betting", "casino", "clickbait", "escort", "gambling",
    "hentai", "jackpot", "lottery", "malware", "nude", "phishing", "pills", "poker", "popup", "porn",
    "roulette", "sex", "slots", "spam", "torrent", "viagra", "warez", "xxx",
)


@dataclass(frozen=True)
class Rule:
    """`host/path` with the verdict for that host, its subdomains and paths that begin so."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        domain, slash, rest = self.text.partition("/")
        return ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?` or `#`, A-Z lower-cased; '' without it."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?` or `#`; '' for null and without `://`."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def _path_tokens(path: Column) -> Column:
    return F.regexp_extract_all(F.translate(path, _UPPER, _LOWER), F.lit("([a-z]+)"), 1)


def _names(host: Column) -> Column:
    return F.regexp_extract_all(host, F.lit(f"([a-z]{{1,{NAME_LETTERS}}})"), 1)


def word_counts(pages: DataFrame, hosts: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n): a-z words of the visible text of all pages and of hyphenated host labels."""
    markup = r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>"
    seen = F.regexp_extract_all(F.lower(F.regexp_replace(html_col, markup, " ")), F.lit(r"(\p{L}+)"), 1)
    label = F.explode(F.split("host", r"\."))
    parts = hosts.select(label.alias("label")).filter(F.col("label").contains("-"))
    parts = parts.select(F.explode(F.regexp_extract_all("label", F.lit("([a-z]+)"), 1)).alias("word"))
    words = pages.select(F.explode(seen).alias("word")).union(parts)
    return words.filter(F.col("word").rlike(f"^[a-z]{{1,{WORD_LETTERS}}}$")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def best_split(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The words of largest probability; `known` counts the substrings (start, length).

    A word met n times has probability n / total, an unknown one of k letters
    10 / (total * 10^k). Of equal splits the one with the longer last word is taken.
    """
    unit = np.log(10.0)
    of_all = np.log(max(total, 1))
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        top, where = -np.inf, 0
        for start in range(max(0, end - WORD_LETTERS), end):
            n = known.get((start, end - start), 0)
            score = best[start] + (np.log(n) if n else unit * (1 - (end - start))) - of_all
            if score > top:
                top, where = score, start
        best.append(top)
        back.append(where)
    words: list[str] = []
    end = len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def segment_names(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words array<string>) for distinct names of at most 63 letters a-z.

    `words`: (word, n). The substrings of a name, at most 63 x 24, meet the word counts
    by a join; then each name is split by itself.
    """
    ship(names.sparkSession)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    starts = F.sequence(F.lit(1), F.length("name"))
    spans = names.filter(F.length("name") > 0).select("name", F.explode(starts).alias("start"))
    room = F.least(F.lit(WORD_LETTERS), F.length("name") - F.col("start") + 1)
    spans = spans.select("name", "start", F.explode(F.sequence(F.lit(1), room)).alias("size"))
    spans = spans.select("name", "start", "size", F.substring("name", F.col("start"), F.col("size")).alias("word"))
    met = with_lookups(spans, "word", words, spread_by=["name", "start"])
    found = F.collect_list(F.when(F.col("n").isNotNull(), F.struct(F.col("start") - 1, "size", "n")))
    known = met.groupBy("name").agg(found.alias("known"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [
                best_split(name, {(s, k): n for s, k, n in (tuple(span.values()) for span in spans)}, total)
                for name, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            lists = pa.array(split, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["name", "words"])

    return known.mapInArrow(work, "name string, words array<string>")


def token_weights(tokens: DataFrame) -> DataFrame:
    """(token, w) for (token, bad, n): log-odds of block against allow, smoothed.

    w counts millionths. Without an example of both classes all weights are 0.
    """
    bad = F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("n_bad")
    good = F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("n_good")
    counts = tokens.groupBy("token").agg(bad, good)
    totals = counts.agg(F.sum("n_bad").alias("bad"), F.sum("n_good").alias("good"), F.count(F.lit(1)).alias("kinds"))
    row = totals.first()
    if not row["bad"] or not row["good"]:
        return counts.select("token", F.lit(0).cast("long").alias("w"))
    log_bad = F.log((F.col("n_bad") + SMOOTHING) / F.lit(row["bad"] + SMOOTHING * row["kinds"]))
    log_good = F.log((F.col("n_good") + SMOOTHING) / F.lit(row["good"] + SMOOTHING * row["kinds"]))
    return counts.select("token", F.round((log_bad - log_good) * UNIT).cast("long").alias("w"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = (),
    *,
    telling: Sequence[str] = TELLING,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, host_words), one row per row of pages.

    rule: the longest rule that fits, else null. verdict: block or allow, the rule's, else
    block where score > 0. score: log-odds of block, from the prior of the distinct hosts,
    the host's words and the path's runs of letters. host_words: the split host.

    Every distinct host is one training example: its words and the distinct path tokens
    found below it, so a host with a third of all pages counts once. Without hosts that
    hold a telling word, or with no others, the method allows everything.

    Null urls and those without `://` have an empty host and path, no words and the
    prior as score. Repeated rows and ids give one row each; null html adds no words.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    scratch = scratch_path(spark, "url_filter")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("trail", F.array_join(F.array_sort(_path_tokens(F.col("path"))), " "))
    hosts = stored(parsed.select("host").distinct(), "hosts")
    words = stored(word_counts(pages.select(F.col(html_col).cast("string").alias("html")), hosts), "words")
    by_name = hosts.select("host", F.posexplode(_names(F.col("host"))).alias("pos", "name"))
    names = stored(by_name.select("name").distinct(), "names")
    split = stored(segment_names(names, words), "split")
    in_hosts = with_lookups(by_name, "name", split, spread_by=["host"])
    ordered = F.array_sort(F.collect_list(F.struct("pos", "words")))
    host_words = in_hosts.groupBy("host").agg(F.flatten(ordered["words"]).alias("host_words"))
    tells = F.arrays_overlap("host_words", F.array(*map(F.lit, telling)).cast("array<string>"))
    host_words = hosts.join(host_words, "host", "left").withColumn("bad", F.coalesce(tells, F.lit(False)))
    host_words = stored(host_words, "host_words")

    of_host = host_words.select("host", "bad", F.explode("host_words").alias("word"))
    of_host = of_host.select("host", "bad", F.concat(F.lit("h:"), "word").alias("token"))
    of_host = of_host.groupBy("host", "bad", "token").agg(F.count(F.lit(1)).alias("n"))
    of_path = parsed.select("host", F.explode(F.split("trail", " ")).alias("word")).filter(F.col("word") != "")
    of_path = of_path.select("host", F.concat(F.lit("p:"), "word").alias("token")).distinct()
    of_path = with_lookups(of_path, "host", host_words.select("host", "bad"), spread_by=["token"])
    examples = of_host.select("token", "bad", "n").union(of_path.select("token", "bad", F.lit(1).cast("long")))
    weights = stored(token_weights(examples), "weights")

    seen = host_words.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).first()
    both = seen["bad"] > 0 and seen["good"] > 0
    prior = round(float(np.log(seen["bad"] / seen["good"])) * UNIT) if both else -UNIT
    added = F.coalesce(F.sum(F.col("w") * F.col("n")), F.lit(0)).cast("long")
    host_scores = with_lookups(of_host, "token", weights, spread_by=["host"]).groupBy("host").agg(added.alias("host_w"))
    trails = parsed.select("trail").distinct()
    of_trail = trails.select("trail", F.explode(F.split("trail", " ")).alias("word"))
    of_trail = of_trail.groupBy("trail", F.concat(F.lit("p:"), "word").alias("token")).agg(F.count(F.lit(1)).alias("n"))
    trail_scores = with_lookups(of_trail, "token", weights, spread_by=["trail"]).groupBy("trail").agg(added.alias("path_w"))
    host_table = host_words.select("host", "host_words").join(stored(host_scores, "host_scores"), "host", "left")
    scored = with_lookups(parsed, "host", stored(host_table, "host_table"), spread_by=["page_id", "path"])
    scored = with_lookups(scored, "trail", stored(trail_scores, "trail_scores"), spread_by=["page_id", "path"])

    total = F.lit(prior) + F.coalesce("host_w", F.lit(0)) + F.coalesce("path_w", F.lit(0))
    by_length = sorted(rules, key=lambda r: (-len(r.text), r.text))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(by_length):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, ruled = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(ruled)
    own = F.when(total > 0, "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(ruled, own).alias("verdict"),
        (total / UNIT).alias("score"),
        F.coalesce("host_words", F.array().cast("array<string>")).alias("host_words"),
    )
