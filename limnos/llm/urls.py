"""URL filters: rules for hosts and paths, and a logistic regression for urls that no rule decides.

The model's features are hashed character n-grams of host and path, kept apart by the part they come from. It is
trained on a small labelled table of urls (``labelled_urls()`` or the caller's) by full-batch gradient descent. Of the rules
that fit a url, the one with the longest host and path decides, the first given of equally long ones.

A null url, or one without ``://``, has an empty host and path; no rule fits it, and the model judges the empty url.
Each row gives one row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from limnos.llm.shared import map_slices, quoted

URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
GRAMS = (3, 4, 5)
BUCKETS = 1 << 13
PATH_NORM = 0.5  # the host tells more
STEPS, RATE, RIDGE = 600, 2.0, 2e-5
LEAST_BLOCK, HELD_BLOCKED = 0.55, 0.005  # the threshold: at least the first; of held-back good rows, the second share is blocked


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: str, path: str) -> bool:
        return (host == self.host or host.endswith("." + self.host)) and path.startswith(self.path)


# The rules that the query applies.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

# What the labelled urls are made of.
BAD_WORDS = """casino jackpot slots roulette poker blackjack betting bets bet gambling lottery bingo win winner bonus
adult xxx porn sex sexy nude cams escorts hot-singles hookup dating-now erotic milf
pills viagra cialis pharmacy no-rx weight-loss diet-pills steroids miracle-cure testosterone
cheap discount free coupon promo deals replica rolex payday-loans fast-cash easy-money credit-fix
spam linkfarm link-farm backlinks seo-boost traffic-exchange clickbait popunder popads adserver ads tracker doubleclick affiliate
crack keygen warez torrents serials nulled cracked-apk phish verify-account crypto-doubler bitcoin-giveaway forex-signals get-rich earn-now
""".split()
GOOD_WORDS = """university library museum archive journal news gazette chronicle observer herald science physics biology history
garden recipes kitchen travel weather climate school lessons teacher student books reader writer poems essays letters
docs wiki forum project software code tutorial python maths astronomy planets music theatre cinema art gallery
health hospital clinic nutrition nature birds rivers mountains village city council government law court parliament
sports football cycling running family parenting craft woodwork bikes trains maps research institute academy college
blog site page home world local daily weekly review magazine press
""".split()
SYLLABLES = "al an ar bel ber bo car chi da del den dor el en er fa fen gar gri ha hel in is jo ka ker la len lin lo ma mar mer mi mon na nor o or pa per ra ren ri ro sa sel sha son ta ten th ther ti tion to tor u ur va ver vi wa wen wick yor za zen".split()
COINED = 2400  # ordinary names that mean nothing
BAD_PATHS = "/free-spins /jackpot/bonus /casino/play /live-cams /xxx/videos /buy/viagra-online /order/cheap-pills /keygen /crack/download /win/iphone /claim-prize /payday/apply-now /banner/728x90 /pixel.gif /ad/click /go/affiliate-offer /redirect/popunder /verify-account/signin /seo/buy-backlinks /replica/rolex".split()
PLAIN_PATHS = "/ /index.html /about /contact /en/ /de/12 /fr/853 /es/474 /en/960 /it/7/ /2021/05/report /page/3 /article/825 /articles/middle-ages /post/119.html /news/local-election /guide/installation /wiki/Mathematics /tag/history /search /questions/12345 /books/612 /archive/1890.html /catalogue/item/44 /en/story/31 /blog/2019/on-reading /download/report.pdf /lessons/grammar /forecast/city /category/culture /view /topic/88 /a/b/c".split()
NAMES = ("{0}", "{0}-{1}", "{0}{1}", "{1}-{0}", "my{0}", "the-{0}-{1}", "{0}24", "{0}online")
SUBDOMAINS = ("www.", "", "m.", "en.", "blog.", "", "www2.", "de.")
SUFFIXES = ("example", "test", "example.org", "example.com", "example.net", "invalid", "com.example", "org.test", "net.example", "co.test", "info.test")
VARIANTS = 8  # hosts made of each word


def _one_of(choices: Sequence[str], *what: object) -> str:
    return choices[crc32(".".join(map(str, what)).encode()) % len(choices)]


def labelled_urls(bad_words: Sequence[str] = BAD_WORDS, good_words: Sequence[str] = GOOD_WORDS) -> list[tuple[str, int]]:
    """Labelled urls, 1 to be blocked: bad hosts with paths of both kinds, good hosts with plain paths, and few with bad ones.

    A bad word makes a host bad beside words of both kinds; forms, subdomains, suffixes and plain paths are chosen by a hash,
    alike for both labels, and tell nothing. Coined names are good: a host that holds nothing bad is not blocked for being
    unknown.
    """
    rows = []

    def add(label: int, name: str, bad_path: bool, *what: object) -> None:
        host = _one_of(SUBDOMAINS, "subdomain", *what) + name + "." + _one_of(SUFFIXES, "suffix", *what)
        rows.append((f"http://{host}{_one_of(BAD_PATHS if bad_path else PLAIN_PATHS, 'path', *what)}", int(label or bad_path)))

    for label, words in ((1, bad_words), (0, good_words)):
        for word in words:
            for v in range(VARIANTS):
                other = _one_of(good_words if label == 0 or v % 2 else bad_words, "other", word, v)
                add(label, _one_of(NAMES, "name", word, v).format(word, other), v == VARIANTS - 1, word, v)
    for k in range(COINED):
        add(0, "".join(_one_of(SYLLABLES, "syllable", k, j) for j in range(2 + k % 3)), False, "coined", k)
    return rows


def split_url(url: str | None) -> tuple[str, str]:
    """Host, lower-cased in A-Z, and path."""
    found = URL.search(url or "")
    return (found[1].translate(A_TO_Z), found[2]) if found else ("", "")


def features(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams and their values; those of the host have a norm of 1, those of the path of PATH_NORM."""
    found, values = [], []
    for part, text in (("h", f"^{host}$"), ("p", f"^{path.translate(A_TO_Z)}$")):
        grams = {text[i : i + n] for n in GRAMS for i in range(len(text) - n + 1)}
        own = np.unique(np.fromiter((crc32((part + g).encode("utf-8", "surrogatepass")) % BUCKETS for g in grams), np.int64, len(grams)))
        found.append(own + (BUCKETS if part == "p" else 0))
        values.append(np.full(len(own), (PATH_NORM if part == "p" else 1) / np.sqrt(max(1, len(own)))))
    return np.concatenate(found), np.concatenate(values)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the buckets of both parts and, last, the bias
    block: float = LEAST_BLOCK


def fit(labelled: Sequence[tuple[str, int]]) -> np.ndarray:
    """Weights by accelerated descent on the logistic loss.

    The table is small by definition. Weights are sums of its rows, so the steps work on one number a row.
    """
    rows = [features(*split_url(url)) for url, _ in labelled]
    labels = np.array([y for _, y in labelled], float)
    products = np.zeros((len(rows), len(rows)), np.float32)
    for start in range(0, 2 * BUCKETS, BUCKETS // 4):
        part = np.zeros((len(rows), BUCKETS // 4), np.float32)
        for row, (own, values) in zip(part, rows):
            here = (own >= start) & (own < start + BUCKETS // 4)
            row[own[here] - start] = values[here]
        products += part @ part.T
    sums, bias = np.zeros(len(labels), np.float32), 0.0
    moved, moved_bias = sums, bias
    for step in range(STEPS if rows else 0):
        pace = np.float32(step / (step + 3))
        ahead, ahead_bias = sums + pace * (sums - moved), bias + pace * (bias - moved_bias)
        error = (1 / (1 + np.exp(-(products @ ahead + ahead_bias))) - labels) / len(labels)
        moved, moved_bias = sums, bias
        sums, bias = (ahead - RATE * (error + RIDGE * ahead)).astype(np.float32), ahead_bias - RATE * error.sum()
    weights = np.zeros(2 * BUCKETS + 1)
    weights[-1] = bias
    for share, (own, values) in zip(sums, rows):
        weights[own] += share * values
    return weights


def train(labelled: Sequence[tuple[str, int]] | None = None) -> Model:
    """The model of all rows; its threshold comes from one fit without a quarter of the rows, drawn by their hash."""
    labelled = labelled_urls() if labelled is None else labelled
    is_held = [crc32(url.encode("utf-8", "surrogatepass")) % 4 == 0 for url, _ in labelled]
    trial = fit([row for row, held in zip(labelled, is_held) if not held])
    good = [blocked_probability(trial, *split_url(url)) for (url, y), held in zip(labelled, is_held) if held and not y]
    return Model(fit(labelled), max(LEAST_BLOCK, float(np.quantile(good, 1 - HELD_BLOCKED)) if good else 0.0))


def blocked_probability(weights: np.ndarray, host: str, path: str) -> float:
    own, values = features(host, path)
    return float(1 / (1 + np.exp(-(weights[own] @ values + weights[-1]))))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: list[tuple[str, int]] | None = None, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule, verdict, and the model's probability of block."""
    model = pages.sparkSession.sparkContext.broadcast(train(labelled))  # of fixed size
    longest_first = sorted(rules, key=lambda r: -len(r.name))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[str | None, tuple] = {}
        rows = []
        for url in batch.column(1).to_pylist():
            if url not in known:
                host, path = split_url(url)
                rule = next((r for r in longest_first if r.fits(host, path)), None)
                p = blocked_probability(model.value.weights, host, path)
                known[url] = (host, path, rule and rule.name, rule.verdict if rule else "block" if p >= model.value.block else "allow", p)
            rows.append(known[url])
        columns = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.float64())
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], ["page_id", "host", "path", "rule", "verdict", "p_block"])

    narrow = pages.select(quoted(id_column).cast("bigint").alias("page_id"), quoted(url_column).cast("string").alias("url"))
    return map_slices(narrow, work, "page_id bigint, host string, path string, rule string, verdict string, p_block double")


def allowed(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url_column: str = "url") -> DataFrame:
    """The rows of ``pages`` whose url is allowed, unchanged."""
    model = pages.sparkSession.sparkContext.broadcast(train())
    longest_first = sorted(rules, key=lambda r: -len(r.name))

    def keep(url: str | None) -> bool:
        host, path = split_url(url)
        rule = next((r for r in longest_first if r.fits(host, path)), None)
        return rule.verdict == "allow" if rule else blocked_probability(model.value.weights, host, path) < model.value.block

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([keep(u) for u in batch.column(batch.schema.get_field_index(url_column)).to_pylist()], pa.bool_()))

    return map_slices(pages, work, pages.schema)
