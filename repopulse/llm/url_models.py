"""URL filter by the ratio of two character language models.

Addresses that the rules allow train one model, those they block another; both are Markov models of
the next character given up to ORDER characters before it, every order smoothed by the next shorter
one. An address without a rule is judged by the difference of its two log-likelihoods per character,
against a cut calibrated on labelled addresses that trained neither model. Only DataFrame operations
are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.store import stored

ORDER = 4
STRENGTH = 4.0  # characters' worth of belief in the shorter context
ALPHABET = 256
UNITS = 1_000_000  # log ratios are whole millionths, so sums don't depend on their order
BIN = 1000
FARTHEST = 20_000
BEGIN, END = "\u0002", "\u0003"
HELD_OUT = ("0", "1", "2", "3")  # first hexadecimal digits of the MD5 of calibrating addresses

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host and the beginning of a path, as in `net/` or `example.net/en/`."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """(text, verdict) of the longest rule that fits a host or one above it and the path; or null."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        under = (host == rule.host) | host.endswith("." + rule.host)
        here = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(under & path.startswith(rule.path), here).otherwise(found)
    return found


def _grams(addresses: DataFrame) -> DataFrame:
    """One row per character of an address and for its end: the character after ORDER others."""
    padded = F.concat(F.lit(BEGIN * ORDER), F.col("address"), F.lit(END))
    places = F.sequence(F.lit(1), F.length("address") + 1)
    return addresses.withColumn("place", F.explode(places)).select(
        *addresses.columns, padded.substr(F.col("place"), F.lit(ORDER + 1)).alias("gram")
    )


def _tails(grams: DataFrame) -> DataFrame:
    """Each gram with its ends of 1 to ORDER + 1 characters and what precedes their last."""
    tails = grams.withColumn("order", F.explode(F.sequence(F.lit(0), F.lit(ORDER))))
    start = F.lit(ORDER + 1) - F.col("order")
    return tails.withColumn("tail", F.col("gram").substr(start, F.col("order") + 1)).withColumn(
        "context", F.col("gram").substr(start, F.col("order"))
    )


def log_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ratio) for every distinct gram of (gram, allowed, blocked), the training counts in it.

    ratio: millionths of the difference of the logarithms of both models' probabilities.
    """
    counted = grams.groupBy("gram").agg(
        F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")
    )
    counted = stored(counted)
    tails = _tails(counted)
    sums = [F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")]
    trained = tails.where("allowed + blocked > 0")
    by_tail = trained.groupBy("tail").agg(*sums)
    by_context = trained.groupBy("order", "context").agg(
        F.sum("allowed").alias("all_allowed"), F.sum("blocked").alias("all_blocked")
    )
    every = tails.select("gram", "order", "tail", "context").join(by_tail, "tail", "left")
    every = every.join(by_context, ["order", "context"], "left")
    names = ("allowed", "blocked", "all_allowed", "all_blocked")
    wide = every.groupBy("gram").agg(
        *[
            F.coalesce(F.max(F.when(F.col("order") == o, F.col(n))), F.lit(0)).alias(f"{n}_{o}")
            for o in range(ORDER + 1)
            for n in names
        ]
    )

    def likelihood(kind: str) -> Column:
        p = F.lit(1.0 / ALPHABET)
        for o in range(ORDER + 1):
            p = (F.col(f"{kind}_{o}") + STRENGTH * p) / (F.col(f"all_{kind}_{o}") + STRENGTH)
        return p

    ratio = F.round(UNITS * (F.ln(likelihood("allowed")) - F.ln(likelihood("blocked"))))
    return wide.select("gram", ratio.cast("bigint").alias("ratio"))


def _best_cut(held: DataFrame) -> int:
    """The lowest bin of best balanced accuracy on (bin, verdict) rows; 0 without both verdicts.

    There are at most 2 FARTHEST + 1 bins, so their counts are looked at here.
    """
    counts = held.groupBy("bin").agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"),
    )
    rows = sorted(tuple(row) for row in counts.collect())
    allowed, blocked = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not allowed or not blocked:
        return 0
    best, cut, good, bad = None, 0, 0, 0
    for place, a, b in reversed(rows):
        good, bad = good + a, bad + b
        gain = good * blocked - bad * allowed
        if best is None or gain >= best:
            best, cut = gain, place
    return cut


def judged(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url"):
    """(page_id, host, path, rule, verdict, score) for every row of `pages`.

    The longest rule that fits decides (allow or block); without one the models do: allow if the
    score, nats per character rounded down to thousandths, reaches the cut. Each distinct address
    (host and path) trains, calibrates and is scored once, however many rows share it.

    Null addresses and those without `://` have an empty host and path and are scored as an empty
    address. Rows that repeat come out as often. Without labelled addresses of both kinds the cut is
    0. An empty table gives an empty one; other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("address", F.concat("host", "path"))
    known = fitting_rule(rules, F.col("host"), F.col("path"))
    addresses = rows.select("address", known["verdict"].alias("verdict")).distinct()
    held = F.substring(F.md5("address"), 1, 1).isin(*HELD_OUT)
    trains = F.col("verdict").isNotNull() & ~held
    grams = _grams(
        addresses.select(
            "address",
            F.when(trains & (F.col("verdict") == "allow"), 1).otherwise(0).alias("allowed"),
            F.when(trains & (F.col("verdict") == "block"), 1).otherwise(0).alias("blocked"),
        )
    )
    ratios = stored(log_ratios(grams.select("gram", "allowed", "blocked")))
    scored = grams.select("address", "gram").join(ratios, "gram").groupBy("address").agg(
        F.sum("ratio").alias("total"), F.count("*").alias("places")
    )
    place = F.floor(F.col("total") / (F.col("places") * F.lit(float(BIN)))).cast("bigint")
    place = F.least(F.greatest(place, F.lit(-FARTHEST)), F.lit(FARTHEST))
    scored = stored(scored.select("address", place.alias("bin")))
    cut = _best_cut(scored.join(addresses.where(held & F.col("verdict").isNotNull()), "address"))
    result = rows.withColumn("known", known).join(scored, "address", "left")
    return result.select(
        "page_id",
        "host",
        "path",
        F.col("known.text").alias("rule"),
        F.coalesce(
            F.col("known.verdict"), F.when(F.col("bin") >= cut, "allow").otherwise("block")
        ).alias("verdict"),
        (F.col("bin") / 1000).alias("score"),
    )
