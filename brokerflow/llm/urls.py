"""Addresses that are wanted: by rules where one fits, and by two character models elsewhere, in DataFrame functions alone.

One model is learned from the addresses that a rule allows, one from those that a rule blocks. Each gives the
probability of a character after the ``ORDER`` characters before it, or after as many of them as it has seen
together: a context's counts are mixed with the estimate of the context that is one character shorter, which
weighs as much as the context has different successors (Witten and Bell). A context that was never seen leaves
the shorter one's estimate as it is.

An address scores the mean over its characters, with one that ends it, of the logarithm of the allowing
model's probability over the blocking one's. It is allowed from a threshold on. The threshold is found on the
addresses that a rule judges and that the models have not seen, ``HELD`` in a hundred by a hash of the address:
the middle of the best scores, where the shares of right verdicts among allowed and among blocked ones have the
largest sum. With none of either kind held out, it is 0.

All addresses that a rule judges are counted, repeated rows too, so that the models grow with the table. Counts
per gram are added up before they are shuffled; a context has no more successors than there are characters.
The table of the grams' logarithms is broadcast up to a measured size, beyond it the join splits hot grams.

Null addresses and those without ``://`` have empty host and path, which no rule fits; they are scored as they
stand, a null one as the empty text. Addresses of any length are read whole. Repeated rows get the same verdict.
An empty table gives no rows. Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerflow.llm.store import settle
from brokerflow.operators.joins import lookup_join

#: Characters of context, and the probability of a character that nothing is known of.
ORDER = 4
UNKNOWN = 1 / 256
#: Of a hundred addresses that a rule judges, those that only the threshold is found on.
HELD = 20
#: The grid of scores on which the threshold is searched.
STEP = 0.001

BEFORE, AFTER = "\u0002", "\u0003"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of an address."""
    there = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.when(there, F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, UPPER.lower())).otherwise("")
    path = F.when(there, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits.

    A rule is a host, which stands for its subdomains as well, and the beginning of a path. Of equally long
    ones the first in the alphabet counts.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        at = text.find("/") if "/" in text else len(text)
        own = (host == text[:at]) | F.endswith(host, F.lit(f".{text[:at]}"))
        fits = own & F.startswith(path, F.lit(text[at:]))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def grams(text: str, order: int = ORDER) -> Column:
    """Every character of a text column, and the end of it, with the ``order`` characters before it.

    The text is split into characters once per row: the outer array binds them to a name.
    """
    gram = ", ".join(f"c[i + {k}]" for k in range(order + 1))
    marked = f"split(concat('{BEFORE * order}', {text}, '{AFTER}'), '')"
    return F.expr(f"flatten(transform(array({marked}), c -> transform(sequence(0, size(c) - {order + 1}), i -> concat({gram}))))")


def models(counted: DataFrame, group: str, order: int = ORDER) -> DataFrame:
    """(gram, ratio): the logarithm of the models' ratio for the last character of each gram.

    ``counted`` has a row per gram of ``order + 1`` characters with its counts ``allow`` and ``block``, both of
    which may be 0.
    """
    shorter = F.expr(f"transform(sequence(1, {order + 1}), n -> right(gram, n))")
    all_lengths = counted.select(F.explode(shorter).alias("gram"), "allow", "block").groupBy("gram")
    summed = all_lengths.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    context = Window.partitionBy(F.expr("left(gram, length(gram) - 1)"))
    successors = [F.sum(k).over(context).alias(f"{k}_all") for k in ("allow", "block")]
    successors += [F.sum((F.col(k) > 0).cast("int")).over(context).alias(f"{k}_kinds") for k in ("allow", "block")]
    levels = settle(summed.select("*", F.length("gram").alias("n"), *successors), group, "contexts")

    def mixed(kind: str, shorter: Column) -> Column:
        seen, kinds = F.col(f"{kind}_all"), F.col(f"{kind}_kinds")
        return F.when(seen > 0, (F.col(kind) + kinds * shorter) / (seen + kinds)).otherwise(shorter)

    known = levels.where("n = 1").select("gram", *[mixed(k, F.lit(UNKNOWN)).alias(f"{k}_p") for k in ("allow", "block")])
    for n in range(2, order + 2):
        below = known.select(F.col("gram").alias("tail"), "allow_p", "block_p")
        longer = levels.where(F.col("n") == n).withColumn("tail", F.expr("substring(gram, 2)")).join(below, "tail")
        known = longer.select("gram", *[mixed(k, F.col(f"{k}_p")).alias(f"{k}_p") for k in ("allow", "block")])
    return known.select("gram", (F.log("allow_p") - F.log("block_p")).alias("ratio"))


def threshold(scored: DataFrame, step: float = STEP) -> float:
    """The score from which on an address is allowed; ``scored`` has score and verdict of addresses that a rule judges.

    Scores are counted on a grid, so the sorted part is as long as the grid. Where several cuts are equally
    good, the middle of the longest such stretch next to the lowest one.
    """
    cells = scored.groupBy(F.floor(F.col("score") / step).alias("cell")).agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    )
    below = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = Window.partitionBy()
    right = [F.try_divide(F.col(k), F.sum(k).over(totals)).alias(k) for k in ("allow", "block")]
    shares = cells.select("cell", F.lag("cell").over(Window.orderBy("cell")).alias("before"), *right)
    gained = shares.withColumn("gain", F.coalesce(F.sum(F.col("block") - F.col("allow")).over(below), F.lit(0.0)))
    best = gained.where("before is not null").orderBy(F.round("gain", 9).desc(), "cell").first()
    return 0.0 if best is None or best["gain"] <= 0 else step * (best["before"] + 1 + best["cell"]) / 2


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], group: str = "urls", order: int = ORDER, held: int = HELD) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score (null where it was not needed)."""
    url = F.col("url")
    host, path = parts(url)
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.coalesce(url, F.lit("")).alias("url"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    open_ = F.col("rule").isNull()
    fold = F.pmod(F.xxhash64("url"), F.lit(100)) < held
    told = read.withColumn("rule", rule).withColumn("verdict", verdict).withColumn("use", F.when(open_, "judge").when(fold, "hold").otherwise("learn"))
    rows = settle(told.withColumn("row", F.monotonically_increasing_id()), group, "addresses")  # stored, so a row keeps its number

    learn = [F.count_if((F.col("use") == "learn") & (F.col("verdict") == k)).alias(k) for k in ("allow", "block")]
    counted = settle(rows.select("use", "verdict", F.explode(grams("url", order)).alias("gram")).groupBy("gram").agg(*learn), group, "grams")
    asked = rows.where("use != 'learn'").select("row", F.explode(grams("url", order)).alias("gram"))
    weighed = lookup_join(asked, models(counted, group, order), ["gram"], ["row"], "inner", "ratios")
    scores = settle(weighed.groupBy("row").agg(F.avg("ratio").alias("score")), group, "scores")

    scored = rows.join(scores, "row", "left")
    limit = threshold(scored.where("use = 'hold'"))
    judged = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"), "score")
