"""Licence scan by ordered signature rules.

Texts that hold none of the word parts that the rules need are done at once.  The others are
normalised to lower-case words, the rules whose keyword they hold are run,
and the detections of all rules are resolved: one that lies within another is
suppressed, and of two that overlap in part the one of lower priority goes.

Only DataFrame functions, and row by row: the scan has no shuffle at all.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower
from .license_rules import BASE, Rule, all_rules, gate

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z became a-z.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    """`` word word ... word ``: the words of a text, a space before and after each."""
    words = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _spaces(col: Column) -> Column:
    return F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))


def running_sum(values: Column) -> Column:
    """Running sums of an array of ints, in chunks of about its root, so long arrays stay cheap."""
    chunk = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(values) - 1), chunk)

    def sums(part: Column) -> Column:
        return F.aggregate(part, F.array().cast("array<int>"), lambda acc, v: F.concat(
            acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + v)))

    def shifted(acc: Column, part: Column) -> Column:
        """One chunk more: acc holds the chunks so far and the sum before this one."""
        own = sums(part)
        return F.struct(
            F.concat(acc["parts"], F.array(F.transform(own, lambda x: x + acc["before"]))).alias("parts"),
            (acc["before"] + F.coalesce(F.try_element_at(own, F.lit(-1)), F.lit(0))).alias("before"))

    parts = F.transform(starts, lambda i: F.slice(values, i + 1, chunk))
    none = F.struct(F.array().cast("array<array<int>>").alias("parts"), F.lit(0).alias("before"))
    return F.flatten(F.aggregate(parts, none, shifted)["parts"])


def rule_table(rules: Sequence[Rule]) -> Column:
    """The rules as a constant: ``[{keyword, rules: [{label, priority, rank, pattern}]}]``."""
    groups: dict[str, list] = {}
    for rank, rule in enumerate(rules):
        groups.setdefault(rule.keyword, []).append(
            {"label": rule.label, "priority": rule.priority, "rank": rank, "pattern": f"(?s)( (?:{rule.pattern}))(?= )"})
    text = json.dumps([{"keyword": k, "rules": v} for k, v in groups.items()])
    return F.from_json(F.lit(text), "array<struct<keyword string, rules array<struct<"
                                    "label string, priority int, rank int, pattern string>>>>")


def detections(norm: Column, rules: Sequence[Rule]) -> Column:
    """Every match of every rule whose keyword the text holds: ``[{start, back, low, rank, label}]``.

    ``start`` and ``-back`` are character positions in the normalised text and
    ``-low`` is the priority, so the natural order of the struct puts earlier,
    then longer, then higher detections first.
    """
    none = F.array().cast("array<struct<start int, back int, low int, rank int, label string>>")

    def matches(rule: Column) -> Column:
        # \G ties each match to the end of the last one: gaps and matches together spell out the text once.
        pattern = F.concat(F.lit(r"(?s)\G(.*?)"), rule["pattern"])
        found = F.regexp_extract_all(norm, pattern, F.lit(2))
        lengths = F.transform(found, lambda m: F.length(m))
        gaps = F.transform(F.regexp_extract_all(norm, pattern, F.lit(1)), lambda g: F.length(g))
        ends = running_sum(F.zip_with(gaps, lengths, lambda g, m: g + m))
        placed = F.zip_with(ends, lengths, lambda e, m: F.struct(
            (e - m).alias("start"), (-e).alias("back"), (-rule["priority"]).alias("low"),
            rule["rank"].alias("rank"), rule["label"].alias("label")))
        return F.when(F.rlike(norm, rule["pattern"]), placed).otherwise(none)

    gated = F.filter(rule_table(rules), lambda g: F.contains(norm, g["keyword"]))
    return F.flatten(F.transform(gated, lambda g: F.flatten(F.transform(g["rules"], matches))))


def resolve(found: Column) -> Column:
    """``{labels, best, kept}``: labels, highest priority and number of the detections that stand.

    One pass in text order.  A detection inside the standing one is
    suppressed; one that reaches beyond it replaces it if its priority is
    higher and is suppressed otherwise; one that begins after it stands next.
    """
    kind = "struct<stop int, low int, label string, labels array<string>, best int, kept int>"
    none = F.struct(F.lit(0).alias("stop"), F.lit(0).alias("low"), F.lit(None).cast("string").alias("label"),
                    F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"), F.lit(0).alias("kept"))

    def settle(acc: Column) -> tuple[Column, Column, Column]:
        """The standing detection joins those that are final."""
        some = acc["label"].isNotNull()
        return (F.when(some, F.array_union(acc["labels"], F.array(acc["label"]))).otherwise(acc["labels"]),
                F.when(some, F.greatest(acc["best"], -acc["low"])).otherwise(acc["best"]),
                F.when(some, acc["kept"] + 1).otherwise(acc["kept"]))

    def step(acc: Column, d: Column) -> Column:
        labels, best, kept = settle(acc)
        after = acc["label"].isNull() | (d["start"] >= acc["stop"])
        takes = after | ((-d["back"] > acc["stop"]) & (d["low"] < acc["low"]))
        return F.struct(
            F.when(takes, -d["back"]).otherwise(acc["stop"]).alias("stop"),
            F.when(takes, d["low"]).otherwise(acc["low"]).alias("low"),
            F.when(takes, d["label"]).otherwise(acc["label"]).alias("label"),
            F.when(after, labels).otherwise(acc["labels"]).alias("labels"),
            F.when(after, best).otherwise(acc["best"]).alias("best"),
            F.when(after, kept).otherwise(acc["kept"]).alias("kept")).cast(kind)

    def finish(acc: Column) -> Column:
        labels, best, kept = settle(acc)
        return F.struct(labels.alias("labels"), best.alias("best"), kept.alias("kept"))

    return F.aggregate(F.array_sort(found), none.cast(kind), step, finish)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: Sequence[Rule] | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, n_kept, score``.

    ``n_base`` counts all places of the base phrases, ``first_word`` and
    ``last_word`` are the smallest and largest word index at which one starts
    (null if none).  ``labels`` are the base labels and those of the
    detections that stand, ``score`` is the highest priority among those over
    100 (0 if none).  Null and empty texts have no words and no labels.
    Extra columns are ignored; repeated rows come back as often as they came.
    """
    rules = all_rules() if rules is None else rules
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lowered = F.lower(text)  # holds every ASCII word part that the ASCII-lowered text holds
    hinted = F.lit(False)
    for stem in gate(rules):
        hinted = hinted | F.contains(lowered, F.lit(stem))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"),
        F.when(hinted, normalised(text)).alias("norm"))
    phrase = "( (?:" + "|".join(BASE.values()) + "))(?= )"
    base = F.regexp_extract_all("norm", F.lit(phrase), F.lit(1))
    before = F.regexp_extract("norm", rf"(?s)^(.*?){phrase}", 1)
    last = F.regexp_extract("norm", rf"(?s)^(.*){phrase}", 1)
    none = F.array().cast("array<string>")
    rows = rows.select(
        "doc_id", "n_words", F.coalesce(base, none).alias("base"),
        F.when(F.size(base) > 0, _spaces(before)).cast("long").alias("first_word"),
        F.when(F.size(base) > 0, _spaces(last)).cast("long").alias("last_word"),
        F.when(F.col("norm").isNotNull(), resolve(detections(F.col("norm"), rules))).alias("found"))
    named = F.array(*(F.when(F.array_contains("base", " " + p), F.lit(label)) for label, p in BASE.items()))
    base_labels = F.array_sort(F.array_compact(named))
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(F.col("found.labels"), none)))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.coalesce(F.col("found.kept"), F.lit(0)).alias("n_kept"),
        (F.coalesce(F.col("found.best"), F.lit(0)) / 100.0).alias("score"))
