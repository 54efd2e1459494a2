"""License scans: phrases that stand word for word, and an exact set-similarity join with license notices.

DataFrame functions only. The join finds every text block that contains at least
`threshold` of a template's distinct words. A block is a line with the LINES - 1 lines
after it, as notices are wrapped. Template words are ordered by
their frequency in the whole corpus, rarest first:

* prefix: a block that holds the threshold of a template of n words holds one of its
  first n - need + 1, so only those are joined on;
* length: a block with fewer than `need` template words is out before the join;
* position: with i template and j block words before the shared one, no more than
  1 + min(n - i, m - j) words can be shared with the shared one the first.

The templates are a parameter, so what is broadcast has the size of that parameter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NAME = "op3_licenses"

#: fixed values: the contract's phrases and labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: the method's templates: notices and the label of each
TEMPLATES = {
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "licensed under the apache license version 2 0 you may not use this file except in compliance": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
}
#: hundredths of a template's distinct words that a block must hold
THRESHOLD = 80
#: lines of a block
LINES = 3

_SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def lowered(text: Column) -> Column:
    """Lower-cased for comparison with ASCII words: of the other letters only the Kelvin sign
    would turn into one, so it is taken out of the way. Words stay where they are."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))


def split_words(low: Column) -> Column:
    """Words between separators; the first and the last may be empty."""
    return F.split(low, f"[{_SEPARATORS}]+")


def count_words(words: Column) -> Column:
    ends = F.when(words[0] == "", 1).otherwise(0) + F.when(
        (F.size(words) > 1) & (F.element_at(words, -1) == ""), 1
    ).otherwise(0)
    return (F.size(words) - ends).cast("long")


def _pattern(phrases: Mapping[str, str]) -> str:
    gap = f"[{_SEPARATORS}]+"
    # longer first: a place is never taken by a shorter phrase that begins there
    every = sorted(phrases, key=lambda p: -len(p.split()))
    alternatives = "|".join(gap.join(p.split()) for p in every)
    return f"(?<![^{_SEPARATORS}])(?:{alternatives})(?![^{_SEPARATORS}])"


def _base(low: Column, words: Column, phrases: Mapping[str, str]) -> dict[str, Column]:
    pattern = _pattern(phrases)
    places = F.regexp_extract_all(low, F.lit(pattern), F.lit(0))
    n = F.size(places)
    before = count_words(split_words(F.split(low, pattern, 2)[0]))
    after = count_words(split_words(F.element_at(F.split(low, pattern), -1)))
    own = count_words(split_words(F.element_at(places, -1)))
    plain = F.transform(places, lambda x: F.regexp_replace(x, f"[{_SEPARATORS}]+", " "))
    labels = [F.when(F.array_contains(plain, p), F.lit(label)) for p, label in phrases.items()]
    return {
        "n_words": count_words(words),
        "n_base": n.cast("long"),
        "first_word": F.when(n > 0, before),
        "last_word": F.when(n > 0, count_words(words) - after - own),
        "_base": F.when(n > 0, F.array_compact(F.array(*labels))).otherwise(F.array().cast("array<string>")),
    }


def template_order(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """Ranks of the templates' words, the rarest in the corpus first."""
    words = F.filter(split_words(lowered(F.col(text))), lambda w: w.isin(vocabulary))
    counted = docs.select(F.explode(words).alias("w")).groupBy("w").count()
    often = {r["w"]: r["count"] for r in counted.collect()}  # at most a row for each word of the templates
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}


def matches(
    docs: DataFrame, id: str, text: str, templates: Mapping[str, str] = TEMPLATES, threshold: int = THRESHOLD
) -> DataFrame:
    """A row (id, block, label, containment) for every block and template that meet the threshold.

    block is the number of its first line in the text, from 0; a text of fewer than LINES lines is one block.
    """
    distinct = {t: sorted(set(t.split())) for t in templates}
    vocabulary = sorted({w for words in distinct.values() for w in words})
    order = template_order(docs, text, vocabulary)
    rows, prefix = [], set()
    for template, label in templates.items():
        words = sorted(distinct[template], key=order.get)
        need = -(-threshold * len(words) // 100)
        for place, word in enumerate(words[: len(words) - need + 1], 1):
            rows.append((word, order[word], place, label, words, need))
            prefix.add(word)
    index = F.broadcast(
        docs.sparkSession.createDataFrame(
            rows, "word string, rank int, place int, label string, words array<string>, need int"
        )
    )
    fewest = min((r[5] for r in rows), default=1)
    ranks = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, order[w])])
    low = lowered(F.col(text))
    possible = docs.select(F.col(id).alias("_id"), low.alias("_low"), split_words(low).alias("_words")).where(
        F.exists("_words", lambda w: w.isin(sorted(prefix)))
    )
    # the words of each line once, then those of the lines of each block
    lines = F.transform(
        F.split("_low", "\n"), lambda line: F.array_distinct(F.filter(split_words(line), lambda w: w.isin(vocabulary)))
    )
    firsts = F.sequence(F.lit(1), F.greatest(F.size("_lines") - LINES + 1, F.lit(1)))
    sets = F.transform(firsts, lambda first: F.array_distinct(F.flatten(F.slice("_lines", first, LINES))))
    blocks = possible.select("_id", lines.alias("_lines")).select("_id", F.posexplode(sets).alias("_block", "_set"))
    m = F.size("_set")
    met = (
        blocks.where(m >= fewest)
        .select("_id", "_block", "_set", F.explode("_set").alias("word"))
        .join(index, "word")
        .where(m >= F.col("need"))
    )
    before = F.size(F.filter("_set", lambda w: F.element_at(ranks, w) < F.col("rank")))
    n, most = F.size("words"), F.least(F.col("place") - 1, before) + 1
    met = met.where(most + F.least(n - F.col("place"), m - before - 1) >= F.col("need"))
    shared = F.size(F.array_intersect("_set", "words"))
    return (
        met.where(shared >= F.col("need"))
        .select(F.col("_id").alias(id), F.col("_block").alias("block"), "label", (shared / n).alias("containment"))
        .distinct()
    )


def scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: 1 with a phrase, else the greatest containment of a template found, else 0.
    A null or empty text has no words and no labels ('' each). Rows that repeat an id
    (or have none) share the template labels of that id. Other columns do not matter.
    """
    low = lowered(F.col(text))
    base = docs.select(F.col(id), low.alias("_low")).select(
        id, *[c.alias(k) for k, c in _base(F.col("_low"), split_words(F.col("_low")), phrases).items()]
    )
    found = (
        matches(docs, id, text, templates, threshold)
        .groupBy(F.col(id).alias("_id"))
        .agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_best"))
    )
    none = F.array().cast("array<string>")
    return base.join(found, F.col(id).eqNullSafe(F.col("_id")), "left").select(
        id,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("_more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEMPLATES = ", ".join(f"('{label}', list_distinct(string_split('{t}', ' ')))" for t, label in TEMPLATES.items())


def _places(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
    return f"list_filter(range(len(w)), lambda i: {same})"


SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '{_WORD}') AS w FROM documents),
places AS (
  SELECT doc_id, len(w) AS n_words, {", ".join(f"{_places(p)} AS p{k}" for k, p in enumerate(PHRASES))} FROM words),
base AS (
  SELECT *, list_concat({", ".join(f"p{k}" for k in range(len(PHRASES)))}) AS every,
    list_filter([{", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(PHRASES.values()))}],
      lambda x: x IS NOT NULL) AS found FROM places),
cut AS (SELECT doc_id, string_split({_LOW}, chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, list_distinct(regexp_extract_all(block, '{_WORD}')) AS s
  FROM (SELECT doc_id, unnest(list_transform(range(1, greatest(len(l) - {LINES} + 1, 1) + 1),
    lambda i: array_to_string(l[i:i + {LINES} - 1], chr(10)))) AS block FROM cut)),
met AS (
  SELECT doc_id, label, len(list_intersect(s, t)) / len(t) AS share
  FROM lines, (VALUES {_TEMPLATES}) AS v(label, t)
  WHERE 100 * len(list_intersect(s, t)) >= {THRESHOLD} * len(t)),
more AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS best FROM met GROUP BY doc_id)
SELECT doc_id, n_words, len(every) AS n_base, list_min(every) AS first_word, list_max(every) AS last_word,
  array_to_string(list_sort(found), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(found, coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(every) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM base LEFT JOIN more USING (doc_id)
"""
