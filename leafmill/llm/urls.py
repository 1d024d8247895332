"""URL filters: host names cut into words by a unigram Viterbi, then naive Bayes over host and path.

The unigram model mixes, half and half, the relative frequencies of the words of all pages'
visible text with a Zipf law over the ranks of a public tokenizer's whole words (its file is a
parameter). All words count, those met once too: their counts stay a table, which is joined to
the substrings of the distinct hosts, so a task holds only what its hosts need. Each label of a host is cut at characters
other than letters and each run of letters into its most probable words; a run of n unknown
letters has probability 10**-n over the number of words; of equal cuts the one whose last word
is longest stays.

A regular plural that the tokenizer lacks has a QUARTER of its singular's share of the Zipf law.

A page is a positive example if a word of its host, or its singular, is a seed and none is exempt
(as in adultliteracy or spamfilter); both lists are parameters. Features are the host's other
words (h:), its top-level label (t:) and the path's and query's tokens (p:), digits as their
count. The seeds themselves are no features, so the classifier learns what comes with them and not
the list. Host and path are fields; a field of more than FIELD tokens counts as FIELD tokens in
all, in training and scoring, so that no long path outweighs many pages. Multinomial naive Bayes
with Laplace smoothing counts over all pages; features met once share one count, whatever the size
of the table. The counts stay a table too, joined to the pages' features. A page's score is the
log odds of its features, with SEED_ODDS for a positive example and the log of the classes' ratio
for others; it is blocked if the score exceeds 0. So a seed blocks unless the rest of the URL
speaks clearly against it, and other pages are blocked by what comes with seeds elsewhere.

Cases: a null or empty URL, or one without a host, has no words and its path's features only; it
is scored, and blocked only by features (a page without any feature and seed never is). Without a
positive or without a negative page there is nothing to learn: scores are 0 and the positive pages
alone are blocked. Repeated rows are counted and scored each. A null page_id stays null. Hosts are
read in lower case without user info and port; characters beyond ASCII part the words. Words of
more than LONGEST letters, which no label of a host may have, aren't looked for in hosts. Null html
counts as empty; scripts and styles, over any number of lines, are no visible text. Other columns
are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import cut

SEEDS = ("adult", "ads", "bets", "betting", "casino", "escort", "gambling", "jackpot", "malware", "phishing", "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx")
EXEMPT = ("blocker", "care", "detector", "education", "filter", "health", "help", "learning", "literacy", "prevention", "protection", "recovery", "removal", "research", "school", "security")
LONGEST, ALPHA, FIELD, SEED_ODDS, QUARTER, UNIT = 63, 1.0, 8, 3.0, 0.25, 1 << 16
PARTS = re.compile(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#\\\s]*)([^#\s]*)")
LETTERS, TOKENS = re.compile("[a-z]+"), re.compile("[a-z]+|[0-9]+")


def split_url(url: str | None) -> tuple[str, str]:
    """Host and the rest up to the fragment, in lower case; a URL without // has a host if its first part has a dot."""
    if not url:
        return "", ""
    m = PARTS.match(url) or PARTS.match("//" + url.strip())
    host, rest = m[1].rpartition("@")[2].lower(), m[2].lower()
    if "//" not in url and "." not in host:
        return "", (host + rest)
    return re.sub(r":\d*$", "", host).strip("."), rest


class Unigram:
    """Log probabilities of words, and the most probable cut of a run of letters."""

    def __init__(self, probabilities: dict[str, float], size: int | None = None) -> None:
        """size: the words of the whole model, where probabilities has only those that are needed."""
        self.log = {w: math.log(p) for w, p in probabilities.items() if p > 0}
        self.longest = max(map(len, self.log), default=1)
        self.unknown = -math.log((len(self.log) if size is None else size) + 1)

    def segment(self, run: str) -> list[str]:
        best, back, tenth = [0.0], [0], math.log(10)
        for i in range(1, len(run) + 1):
            top, at = -math.inf, 0
            for j in range(max(0, i - max(self.longest, LONGEST)), i):
                own = self.log.get(run[j:i])
                score = best[j] + (own if own is not None else self.unknown - (i - j) * tenth)
                if score > top:
                    top, at = score, j
            best.append(top)
            back.append(at)
        out, i = [], len(run)
        while i:
            out.append(run[back[i] : i])
            i = back[i]
        return out[::-1]


def zipf(path: str) -> dict[str, float]:
    """Whole words of the tokenizer's file by rank; probabilities add up to 1."""
    with open(path) as f:
        ranked = sorted(json.load(f)["model"]["vocab"].items(), key=lambda x: x[1])
    words = [w[:-4] for w, _ in ranked if w.endswith("</w>")]
    words = [w for w in words if LETTERS.fullmatch(w) and len(w) > 1]
    weight = {w: 1 / (i + 2.7) for i, w in enumerate(words)}
    weight |= {w + "s": QUARTER * x for w, x in weight.items() if len(w) > 2 and w[-1] != "s" and w + "s" not in weight}
    total = sum(weight.values())
    return {w: x / total for w, x in weight.items()}


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, count) of all words of all pages' text."""
    text = F.regexp_replace(F.lower("html"), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&\w+;", " ")
    words = pages.select(F.explode(F.split(text, "[^a-z]+")).alias("word")).where("length(word) >= 2")
    return cut(words.groupBy("word").count())


def unigram(pages: DataFrame, vocabulary: str) -> Unigram:
    """The whole model in one place, for small tables."""
    counts, prior = {r["word"]: r["count"] for r in word_counts(pages).collect()}, zipf(vocabulary)
    total = sum(counts.values())
    return Unigram({w: (counts.get(w, 0) / max(1, total) + prior.get(w, 0.0)) / 2 for w in counts.keys() | prior.keys()})


def host_words(host: str, model: Unigram) -> list[str]:
    """The words of all labels but the top-level one."""
    return [w for label in host.split(".")[:-1] for run in LETTERS.findall(label) for w in model.segment(run)]


def is_seed(word: str, seeds: frozenset[str]) -> bool:
    return word in seeds or (word[-1:] == "s" and word[:-1] in seeds)


def is_positive(words: list[str], seeds: frozenset[str], exempt: frozenset[str]) -> bool:
    return any(is_seed(w, seeds) for w in words) and exempt.isdisjoint(words)


def features(host: str, words: list[str], rest: str, seeds: frozenset[str] = frozenset(SEEDS)) -> list[str]:
    own = ["h:" + w for w in words if not is_seed(w, seeds)]
    if host:
        own.append("t:" + host.rpartition(".")[2])
    return own + ["p:" + (f"#{len(t)}" if t[0].isdigit() else t) for t in TOKENS.findall(rest) if not is_seed(t, seeds)]


def weights(own: list[str]) -> dict[str, int]:
    """Each feature's weight in units of 1 / UNIT of a token: its count, less where the field has more than FIELD tokens."""
    counts = Counter(own)
    long = Counter(f[0] == "p" for f in own)
    return {f: UNIT * n if (m := long[f[0] == "p"]) <= FIELD else round(UNIT * n * FIELD / m) for f, n in counts.items()}


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, host, rest) of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, rest = zip(*map(split_url, batch.column("url").to_pylist())) if len(batch) else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(host, pa.string()), pa.array(rest, pa.string())], names=["page_id", "host", "rest"])

    return pages.selectExpr("cast(page_id as bigint) page_id", "cast(url as string) url").mapInArrow(run, "page_id bigint, host string, rest string")


def substrings(hosts: DataFrame) -> DataFrame:
    """(host, word): the distinct substrings of each host's labels but the top-level one that may be words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host in batch.column("host").to_pylist():
                own = {r[i:j] for label in host.split(".")[:-1] for r in LETTERS.findall(label) for i in range(len(r)) for j in range(i + 2, min(len(r), i + LONGEST) + 1)}
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array([host] * len(own), pa.string()), pa.array(list(own), pa.string())], names=["host", "word"])

    return hosts.mapInArrow(run, "host string, word string")


def host_table(hosts: DataFrame, counts: DataFrame, vocabulary: str) -> DataFrame:
    """(host, words) of each distinct host."""
    prior = zipf(vocabulary)
    total = counts.agg(F.sum("count")).first()[0] or 0
    ranked = counts.sparkSession.createDataFrame(pa.table({"word": list(prior)}))
    size = counts.count() + len(prior) - counts.join(ranked, "word", "left_semi").count()
    met = substrings(hosts).join(counts, "word").groupBy("host").agg(F.collect_list(F.struct("word", "count")).alias("met"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram({w: p / 2 for w, p in prior.items()}, size)
        for batch in batches:
            out = []
            for host, own in zip(batch.column("host").to_pylist(), batch.column("met").to_pylist()):
                own = {x["word"]: x["count"] for x in own or ()}
                old = {w: model.log[w] for w in own if w in model.log}
                model.log.update({w: math.log((c / total + prior.get(w, 0.0)) / 2) for w, c in own.items()})
                out.append(host_words(host, model))
                for w in own:
                    del model.log[w]
                model.log.update(old)
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.list_(pa.string()))], names=["host", "words"])

    return hosts.join(met, "host", "left").select("host", "met").mapInArrow(run, "host string, words array<string>")


WEIGHED = "array<struct<feature:string,w:bigint>>"


def segmented(pages: DataFrame, vocabulary: str, seeds: tuple[str, ...] = SEEDS, exempt: tuple[str, ...] = EXEMPT) -> DataFrame:
    """(page_id, host, words, features, positive) of each page; features with their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good, kind = frozenset(seeds), frozenset(exempt), pa.list_(pa.struct([("feature", pa.string()), ("w", pa.int64())]))
        for batch in batches:
            hosts, rests, words = (batch.column(c).to_pylist() for c in ("host", "rest", "words"))
            own = [[{"feature": f, "w": x} for f, x in weights(features(h, w, r, bad)).items()] for h, w, r in zip(hosts, words, rests)]
            positive = [is_positive(w, bad, good) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("words"), pa.array(own, kind), pa.array(positive, pa.bool_())],
                names=["page_id", "host", "words", "features", "positive"],
            )

    own = cut(parsed(pages))
    known = host_table(own.select("host").distinct(), word_counts(pages), vocabulary)
    return own.join(known, "host").select("page_id", "host", "rest", "words").mapInArrow(run, f"page_id bigint, host string, words array<string>, features {WEIGHED}, positive boolean")


def bayes(found: DataFrame, alpha: float = ALPHA) -> tuple[float, DataFrame, Callable, tuple[int, int]] | None:
    """Prior log odds, the weights of the features met more than once, the log odds of two weights, and the others' weights; None where there are no two classes."""
    classes = {r["positive"]: r["count"] for r in found.groupBy("positive").count().collect()}
    if not classes.get(True) or not classes.get(False):
        return None
    each = found.select(F.explode("features").alias("f"), "positive").select("f.feature", "f.w", "positive")
    counts = cut(each.groupBy("feature").agg(F.count("*").alias("pages"), F.max("w").alias("most"), F.sum(F.when(F.col("positive"), F.col("w")).otherwise(0)).alias("high"), F.sum(F.when(F.col("positive"), 0).otherwise(F.col("w"))).alias("low")))
    once = (F.col("pages") == 1) & (F.col("most") <= UNIT)
    t = counts.agg(F.sum("high"), F.sum("low"), F.count_if(~once), F.sum(F.when(once, F.col("high"))), F.sum(F.when(once, F.col("low")))).first()
    high, low, size = (t[0] or 0) / UNIT, (t[1] or 0) / UNIT, t[2] + 1
    odds = lambda a, b: math.log((a / UNIT + alpha) / (high + alpha * size)) - math.log((b / UNIT + alpha) / (low + alpha * size))
    return math.log(classes[True]) - math.log(classes[False]), counts.where(~once).select("feature", "high", "low"), odds, (t[3] or 0, t[4] or 0)


def url_filter(pages: DataFrame, vocabulary: str, seeds: tuple[str, ...] = SEEDS, exempt: tuple[str, ...] = EXEMPT) -> DataFrame:
    """(page_id, host, words, score, blocked) of every page; words are the host's, joined by spaces, score the log odds."""
    found = cut(segmented(pages, vocabulary, seeds, exempt).withColumn("at", F.monotonically_increasing_id()))
    model = bayes(found)
    own = found.select("at", "page_id", "host", F.array_join("words", " ").alias("words"), "positive")
    if model is None:
        return own.select("page_id", "host", "words", F.lit(0.0).alias("score"), F.col("positive").alias("blocked"))
    prior, counts, odds, rare = model
    each = found.select("at", F.explode("features").alias("f")).select("at", "f.feature", "f.w")
    weighed = each.join(counts, "feature", "left").groupBy("at").agg(F.collect_list(F.struct("high", "low", "w")).alias("met"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = odds(*rare)
        for batch in batches:
            lists, positive = batch.column("met").to_pylist(), batch.column("positive").to_pylist()
            scores = [round(math.fsum([SEED_ODDS if bad else prior, *((other if x["high"] is None else odds(x["high"], x["low"])) * x["w"] / UNIT for x in met or ())]), 6) for met, bad in zip(lists, positive)]
            blocked = [bool((met or bad) and s > 0) for s, met, bad in zip(scores, lists, positive)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "words")), pa.array(scores, pa.float64()), pa.array(blocked, pa.bool_())], names=["page_id", "host", "words", "score", "blocked"])

    return own.join(weighed, "at", "left").select("page_id", "host", "words", "positive", "met").mapInArrow(run, "page_id bigint, host string, words string, score double, blocked boolean")
