"""Benchmark decontamination by winnowed word-gram hashes, in DataFrame functions alone.

A text's fingerprints are the least gram hash of each run of ``WINDOW - GRAM + 1`` grams, so two texts
that share ``WINDOW`` words share a fingerprint. Document and item fingerprints are joined. Around every
hit, the windows of ``WINDOW`` words that hold the gram are compared with the items' windows as text,
so a hash that two grams share by chance changes nothing.

An item with fewer words than ``WINDOW`` is one window. Such items can't be found by winnowing; if a
length below ``WINDOW`` occurs among the items, the documents' windows of that length are all joined.

Rows are numbered once, in a stored table, and told apart by that number alone. Texts are not shuffled for
the search: fingerprints meet the items' by broadcast up to a measured size, and by a join that splits hot
ones beyond it; only the texts that hit are looked at again. Every step is linear in a text's words, so
documents and items may have any length.

Null texts have no words: nothing hits them and they hit nothing. Every row is judged by its own text, also
where ids are null or occur several times; repeated rows get the same result. Null ``item_id`` is left out of
the item lists, and items with the same id are one. Of the tables, only ``doc_id``, ``item_id`` and ``text``
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.store import numbered, settle, tasks
from brokerflow.llm.text import let
from brokerflow.operators.joins import lookup_join
from brokerflow.plans.scratch import fits_broadcast, settle_measured

WINDOW = 10
GRAM = 5

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> str:
    """SQL for the words of a text column."""
    cut = f"split(translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}'), r'{NO_WORD}')"
    return f"array_remove({cut}, '')"


def grams_of(words: str, gram: int = GRAM) -> str:
    """SQL for the hash of every ``gram`` consecutive words."""
    parts = ", ".join(["x", *(f"h[i + {k}]" for k in range(1, gram))])
    return let("h", f"transform({words}, x -> xxhash64(x))", f"transform(slice(h, 1, greatest(size(h) - {gram - 1}, 0)), (x, i) -> xxhash64({parts}))")


def prints_of(words: str, window: int = WINDOW, gram: int = GRAM) -> str:
    """SQL for the distinct least hashes of the gram runs."""
    run = window - gram + 1
    least = ", ".join(["x", *(f"g[i + {k}]" for k in range(1, run))])
    runs = f"transform(slice(g, 1, greatest(size(g) - {run - 1}, 0)), (x, i) -> least({least}))"
    return let("g", grams_of(words, gram), f"array_distinct({runs})")


def _windows(starts: str, words: str, length: str | int) -> Column:
    """A row per start: the start and, as text, the window there."""
    return F.explode(F.expr(f"transform({starts}, s -> struct(s AS start, array_join(slice({words}, s + 1, {length}), ' ') AS window))"))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, length, window): every window of every item, as text; ``items`` has item_id and words."""
    sized = items.withColumn("length", F.least(F.size("words"), F.lit(window))).filter("length > 0")
    found = sized.select("item_id", "length", _windows("sequence(0, size(words) - length)", "words", "length").alias("w"))
    return found.select("item_id", "length", "w.window").distinct()


def _hits(rows: DataFrame, item_prints: DataFrame, window: int, gram: int, group: str) -> DataFrame:
    """(row, start, length, window) of the windows around every gram that is an item's fingerprint.

    A document that shares a window has such a gram among its own fingerprints; only those that do are read again.
    """
    met = lookup_join(rows.select("row", F.explode("prints").alias("gram")), item_prints, ["gram"], ["row"], "inner", "item_prints")
    texts = lookup_join(rows.select("row", F.col("doc.text").alias("text")), met.select("row").distinct(), ["row"], ["row"], "inner", "met")
    held = settle(texts.select("row", F.expr(words_of("text")).alias("words")), group, "met_texts")
    places = held.select("row", F.posexplode(F.expr(grams_of("words", gram))).alias("place", "gram"))
    shared = lookup_join(places, item_prints, ["gram"], ["row", "place"], "inner", "item_prints")
    at = shared.groupBy("row").agg(F.collect_set("place").alias("places"))
    back = window - gram
    around = f"filter(flatten(transform(places, p -> sequence(greatest(p - {back}, 0), p))), s -> s + {window} <= size(words))"
    started = lookup_join(held, at, ["row"], ["row"], "inner", "places").withColumn("starts", F.expr(f"array_distinct({around})"))
    found = started.select("row", _windows("starts", "words", window).alias("w"))
    return found.select("row", "w.start", F.lit(window).alias("length"), "w.window")


def _short_hits(rows: DataFrame, length: int) -> DataFrame:
    """All windows of a length that is too short for fingerprints."""
    held = rows.filter(F.col("n_words") >= length).select("row", F.expr(words_of("doc.text")).alias("words"))
    starts = f"transform(sequence(0, size(v) - {length}), s -> struct(s AS start, array_join(slice(v, s + 1, {length}), ' ') AS window))"
    found = held.select("row", F.explode(F.expr(let("v", "words", starts))).alias("w"))
    return found.select("row", "w.start", F.lit(length).alias("length"), "w.window")


def _judged(docs: DataFrame, benchmark: DataFrame, group: str, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """The numbered rows (row, doc, n_words), and those with a hit (row, n_hit, n_items, items_sha256)."""
    found = let("w", words_of("text"), f"struct(cast(size(w) AS long) AS n_words, {prints_of('w', window, gram)} AS prints)")  # split once
    rows = numbered(docs.select(F.struct("*").alias("doc"), F.expr(found).alias("found")), group, "rows").select("row", "doc", "found.*")

    dealt = benchmark.select("item_id", "text").repartition(tasks(docs.sparkSession), "item_id", "text")  # long items apart
    items = settle(dealt.select("item_id", F.expr(words_of("text")).alias("words")), group, "items")
    item_prints = items.select(F.explode(F.expr(prints_of("words", window, gram))).alias("gram")).distinct()
    windows = settle(item_windows(items, window), group, "windows")

    hits = _hits(rows, settle(item_prints, group, "item_prints"), window, gram, group)
    for length in sorted(r[0] for r in windows.filter(F.col("length") < window).select("length").distinct().collect()):
        hits = hits.unionByName(_short_hits(rows, length))
    named = windows.groupBy("window", "length").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    found = settle(lookup_join(hits, named, ["window", "length"], ["row", "start"], "inner", "item_windows"), group, "found")

    covered = F.expr("size(array_distinct(flatten(collect_set(sequence(start, start + length - 1)))))").cast("long")
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids"))))
    listed = found.groupBy("row").agg(covered.alias("n_hit"), ids.alias("ids"))
    digest = F.sha2(F.array_join("ids", ","), 256)
    return rows.drop("prints"), listed.select("row", "n_hit", F.size("ids").cast("long").alias("n_items"), digest.alias("items_sha256"))


def contamination(docs: DataFrame, benchmark: DataFrame, group: str = "winnow", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, hit = _judged(docs.select("doc_id", "text"), benchmark, group, window, gram)
    known = lookup_join(rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), "n_words"), hit, ["row"], ["row"], "left", "hit")
    none = F.lit(0).cast("long")
    return known.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", none) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, group: str = "winnow", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with all their columns."""
    rows, hit = _judged(docs, benchmark, group, window, gram)
    hit, size = settle_measured(hit.select("row"), "hit")
    return rows.join(F.broadcast(hit) if fits_broadcast(size) else hit, "row", "left_anti").select("doc.*")
