"""Quality rules: base rules on words and repetition, then divergence from the language's references.

Per document, over its words `[^\\x20\\x09-\\x0D]+`: the histogram of character
classes and the histogram of the language's common words (the rest in one bin).
A language's references are the sums of the same histograms over all its
documents that pass the base rules. A document is kept if the Jensen-Shannon
distance (square root of the divergence in bits) from both references is below
its threshold. Texts of fewer than `MIN_WORDS` words are left to the base rules:
their histograms say too little. DataFrame functions only; the texts are read
once, and what the two steps share is a narrow table in the shared folder.

Inside a text, repeated windows are found by sorting 64-bit hashes of the
windows, so a text of n words costs n log n.

* null text: no words; the base rules fail it.
* documents of a language outside `COMMON` (or null) are compared with all such documents together, so a single one is only
  compared with itself.
* nothing passes the base rules in a language: no reference, and only the base rules decide.
* an empty table gives no rows; a very long text is one row, sorted by one task.
* repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightops.llm.common import words
from flightops.session import stage_table

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
CLASS_LIMIT, WORD_LIMIT = 0.30, 0.19

# Frequent words of each language, in order of frequency.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "as", "with", "be", "by", "this", "from", "or"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "au", "sur", "pas", "avec"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "lo"],
}
#: Characters of a class, as the inside of a regular expression class; what is in none of them is the last bin.
CLASSES = {"upper": "\\p{Lu}", "digit": "\\p{Nd}", "symbol": "#*$%&|<>", "stop": ".,;:!?", "lower": "\\p{Ll}"}


def _count_chars(text: Column, chars: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{chars}]+", ""))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, chars, common), one row a document."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lang = F.when(F.col(f"`{lang_col}`").isin(list(COMMON)), F.col(f"`{lang_col}`"))
    lists = reduce(lambda out, k: F.when(F.col("lang") == k, F.array(*map(F.lit, COMMON[k]))).otherwise(out), COMMON,
                   F.array(*map(F.lit, list(dict.fromkeys(w for one in COMMON.values() for w in one)))))
    known = sorted({w for one in COMMON.values() for w in one})
    # Each step's arrays are columns of their own and used more than once, so that Catalyst keeps them apart.
    step = docs.select(F.col(f"`{id_col}`").alias("id"), lang.alias("lang"), text.alias("text"))
    step = step.withColumn("w", words(F.col("text")))
    step = step.withColumns({
        "n_words": F.size("w"),
        "joined": F.array_join("w", ""),
        "h": F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(
            F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).otherwise(F.array().cast("array<bigint>")),
        "lines": F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0),
        "found": F.filter(F.col("w"), lambda x: x.isin(known)),
        "list": lists,
    })
    step = step.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    repeated = F.filter(F.col("s"), lambda x, k: (x["h"] == F.get("s", k - 1)["h"]) | (x["h"] == F.get("s", k + 1)["h"]))
    step = step.withColumn("at", F.coalesce(F.sort_array(F.transform(repeated, lambda x: x["i"])), F.array().cast("array<int>")))
    covered = F.aggregate(F.transform("at", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1), x + 3) - x)),
                          F.lit(0), lambda a, x: a + x)
    per_class = [_count_chars(F.col("joined"), chars) for chars in CLASSES.values()]
    step = step.withColumns({
        "word_chars": F.char_length("joined"), "n_symbols": _count_chars(F.col("text"), CLASSES["symbol"]),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "n_repeat_words": covered,
        "chars": F.array(*per_class),
        "common": F.transform("list", lambda c: F.size(F.filter("found", lambda x: x == c))), "n_found": F.size("found"),
    })
    step = step.withColumns({
        "chars": F.concat("chars", F.array(F.col("word_chars") - F.aggregate("chars", F.lit(0), lambda a, x: a + x))),
        "common": F.concat("common", F.array(F.col("n_words") - F.aggregate("common", F.lit(0), lambda a, x: a + x))),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return step.select("id", "lang", *[F.col(c).cast("long").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], failed.alias("base_failed"), "chars", "common")


def references(feats: DataFrame) -> DataFrame:
    """(ref_lang, ref_chars, ref_common): one row a language of COMMON, and one with ref_lang null for all others."""
    n_chars, n_lists = len(CLASSES) + 1, {k: len(v) + 1 for k, v in COMMON.items()}
    widest = len(set(w for one in COMMON.values() for w in one)) + 1
    sums = (feats.where(~F.col("base_failed")).groupBy("lang")
            .agg(F.array(*[F.sum(F.get("chars", F.lit(i))) for i in range(n_chars)]).alias("ref_chars"),
                 F.array(*[F.sum(F.get("common", F.lit(i))) for i in range(widest)]).alias("ref_common")))
    wide = reduce(lambda out, k: F.when(F.col("lang") == k, F.lit(n_lists[k])).otherwise(out), n_lists, F.lit(widest))
    return sums.select(F.col("lang").alias("ref_lang"), "ref_chars", F.slice("ref_common", F.lit(1), wide).alias("ref_common"))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def js_distance(p: Column, q: Column, n: Column, m: Column) -> Column:
    """Jensen-Shannon distance of two histograms of one width with the totals n and m; null if one is empty.

    The divergence that n draws from the reference itself have on average, (bins - 1) / (8 n ln 2), is taken off
    first, so that a short text is not far away only for being short.
    """
    def half(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    each = F.zip_with(p, q, lambda a, b: half(a / n, (a / n + b / m) / 2) + half(b / m, (a / n + b / m) / 2))
    by_chance = (F.size(p) - 1) / (F.lit(8 * math.log(2)) * n)
    return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(F.lit(0.0), _total(each) / 2 - by_chance)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """Features with class_distance, word_distance and kept."""
    feats = stage_table(features(docs, id_col, text_col, lang_col), "quality")
    refs = references(feats).withColumns({"ref_n": _total(F.col("ref_chars")), "ref_m": _total(F.col("ref_common"))})
    both = feats.join(F.broadcast(refs), F.col("lang").eqNullSafe(F.col("ref_lang")), "left")  # a row a language, and one more
    both = both.withColumns({
        "class_distance": js_distance(F.col("chars"), F.col("ref_chars"), F.col("word_chars"), F.col("ref_n")),
        "word_distance": js_distance(F.col("common"), F.col("ref_common"), F.col("n_words"), F.col("ref_m"))})
    far = (F.coalesce("class_distance", F.lit(0.0)) > class_limit) | (F.coalesce("word_distance", F.lit(0.0)) > word_limit)
    return (both.withColumn("kept", ~F.col("base_failed") & ~far)
            .drop("ref_lang", "ref_chars", "ref_common", "ref_n", "ref_m"))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of op4 over documents."""
    return judge(docs.select("doc_id", "text", "lang")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    """DuckDB SQL for op4 over the languages of COMMON."""
    lists = ", ".join(f"('{lang}', '{w}')" for lang, ws in COMMON.items() for w in ws)
    classes = " UNION ALL ".join(f"SELECT doc_id, lang, base_failed, 'c' AS kind, '{name}' AS bin, length(regexp_replace(joined, '[^{chars}]+', '', 'g')) AS n, "
                                 "word_chars AS total FROM b" for name, chars in CLASSES.items())
    return f"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
), t AS (
  SELECT doc_id, a, words[a] || ' ' || words[a + 1] || ' ' || words[a + 2] AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS a FROM w WHERE len(words) >= 3) x
), d AS (
  SELECT doc_id, a FROM t QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
), c AS (
  SELECT doc_id, count(DISTINCT a + i) AS n FROM d, range(3) r(i) GROUP BY doc_id
), l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w
), e AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), b AS (
  SELECT w.doc_id, lang, words, array_to_string(words, '') AS joined, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(e.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(words) < {MIN_WORDS} OR 100 * coalesce(c.n, 0) > {MAX_REPEAT_PERCENT} * len(words) AS base_failed
  FROM w LEFT JOIN c USING (doc_id) LEFT JOIN e USING (doc_id)
), f AS (
  SELECT lang, word FROM (VALUES {lists}) v(lang, word)
), hw AS (
  SELECT b.doc_id, b.lang, base_failed, f.word AS bin, count(u.word) AS n, n_words AS total FROM b JOIN f ON f.lang = b.lang
  LEFT JOIN (SELECT doc_id, unnest(words) AS word FROM b) u ON u.doc_id = b.doc_id AND u.word = f.word GROUP BY ALL
), hc AS ({classes}), h AS (
  SELECT doc_id, lang, base_failed, 'w' AS kind, bin, n, total FROM hw
  UNION ALL SELECT doc_id, lang, base_failed, 'w', '', total - sum(n), total FROM hw GROUP BY doc_id, lang, base_failed, total
  UNION ALL SELECT doc_id, lang, base_failed, kind, bin, n, total FROM hc
  UNION ALL SELECT doc_id, lang, base_failed, 'c', 'rest', total - sum(n), total FROM hc GROUP BY doc_id, lang, base_failed, total
), q AS (
  SELECT lang, kind, bin, m, sum(m) OVER (PARTITION BY lang, kind) AS total FROM (
    SELECT lang, kind, bin, sum(n) AS m FROM h WHERE NOT base_failed GROUP BY lang, kind, bin) x
), j AS (
  SELECT doc_id, kind, count(*) AS bins, max(h.total) AS n,
         sum(CASE WHEN h.n > 0 THEN (h.n / h.total) * log2((h.n / h.total) / ((h.n / h.total + m / q.total) / 2)) ELSE 0 END
           + CASE WHEN m > 0 THEN (m / q.total) * log2((m / q.total) / ((h.n / h.total + m / q.total) / 2)) ELSE 0 END) / 2 AS js
  FROM h JOIN q USING (lang, kind, bin) WHERE h.total > 0 AND q.total > 0 GROUP BY doc_id, kind
), z AS (
  SELECT doc_id, max(sqrt(greatest(0, js - (bins - 1) / (8 * ln(2) * n)))) FILTER (kind = 'c') AS dc,
         max(sqrt(greatest(0, js - (bins - 1) / (8 * ln(2) * n)))) FILTER (kind = 'w') AS dw FROM j GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(dc, 0) <= {CLASS_LIMIT} AND coalesce(dw, 0) <= {WORD_LIMIT} AS kept
FROM b LEFT JOIN z USING (doc_id)
"""


ORACLE = _oracle()
