"""Quality rules: base counts, and how far a text is from its language.

A text has two histograms: its characters by class, and its words, with a bin
for each of the most frequent words of its language and one for all others.
Each is compared with the same histogram of the whole language by the
Jensen-Shannon distance (base 2, from 0 to 1). Short texts give too little to
compare: below a least length a histogram is not judged, and above it the
bound allows for the distance that a sample of that size has by chance.

Everything is built-in SQL functions; a text is never moved: the counts of
the languages are sums, and their histograms are joined to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

#: Share of words in repeated windows (percent) and number of words that fail a text.
REPEAT_PERCENT, LEAST_WORDS, WINDOW_WORDS = 20, 10, 5
#: Words of a language with a bin of their own.
COMMON = 30
#: Characters and words below which the histograms are not judged.
LEAST_CHARS, LEAST_COMMON_WORDS = 200, 50
#: Distances from which a text is rejected, before the allowance for its length.
CHAR_DISTANCE, WORD_DISTANCE = 0.2, 0.25
#: Classes of characters, in the order in which they are taken out of the text; the rest is the last class.
CLASSES = ("[a-z]", "[ \\x09-\\x0D]", "[A-Z]", "[^\\x00-\\x7F]", "[.,;:!?'\"()\\-]", "[0-9]", "[#*$%&|<>]")
SYMBOLS = 6  # the place of the symbols in them, from 0
_BLANK = "[ \\x09-\\x0D]+"


def _sql(pattern: str) -> str:
    """A pattern as a SQL literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _class_counts(docs: DataFrame) -> DataFrame:
    """Adds ``classes``, the characters of ``__text`` by class."""
    left = "__text"
    for k, c in enumerate(CLASSES):  # what is left gets shorter from class to class
        docs = docs.withColumn(f"__left{k}", F.expr(f"regexp_replace({left}, {_sql(c + '+')}, '')"))
        left = f"__left{k}"
    size = ["length(__text)", *[f"length(__left{k})" for k in range(len(CLASSES))]]
    counts = [f"{a} - {b}" for a, b in zip(size, size[1:])] + [size[-1]]
    return docs.withColumn("classes", F.expr(f"array({', '.join(counts)})")).drop(*[f"__left{k}" for k in range(len(CLASSES))])


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON) -> DataFrame:
    """Per language (null: ``und``), counted over all its texts: ``class_share``
    (of its characters), ``common`` (its most frequent words, lower-cased; ties
    in order of the word) and ``word_share`` (of its words)."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("__lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    count = [F.expr(f"sum(classes[{k}])").alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    classes = _class_counts(rows).groupBy("__lang").agg(*count)
    total = " + ".join(f"c{k}" for k in range(len(CLASSES) + 1))
    classes = classes.selectExpr("__lang", "array(" + ", ".join(
        f"c{k} / greatest({total}, 1)" for k in range(len(CLASSES) + 1)) + ") AS class_share")
    words = rows.select("__lang", F.explode(F.split("__text", _BLANK)).alias("w")).where("w <> ''")
    words = words.groupBy("__lang", "w").agg(F.count("*").alias("n")).select("__lang", F.lower("w").alias("w"), "n")
    counted = keep(words.groupBy("__lang", "w").agg(F.sum("n").alias("n")), "quality-words")
    all_words = counted.groupBy("__lang").agg(F.sum("n").alias("total"))
    top = counted.withColumn("place", F.row_number().over(
        Window.partitionBy("__lang").orderBy(F.desc("n"), "w"))).where(F.col("place") <= common)
    top = top.groupBy("__lang").agg(F.sort_array(F.collect_list(F.struct("place", "w", "n"))).alias("t")).join(all_words, "__lang")
    top = top.selectExpr("__lang", "t.w AS common", "transform(t, x -> x.n / total) AS word_share")
    return classes.join(top, "__lang", "left").selectExpr(
        "__lang", "class_share", "coalesce(common, array()) AS common", "coalesce(word_share, array()) AS word_share")


def _divergence(p: str, q: str) -> str:
    """SQL: a bin's part of the Jensen-Shannon divergence of two shares."""
    def half(a, b):
        return f"IF({a} > 0, {a} * log2(2 * {a} / ({a} + {b})) / 2, 0D)"
    return f"({half(p, q)} + {half(q, p)})"


def quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", carry: tuple[str, ...] = ("doc_id",),
            references: DataFrame | None = None) -> DataFrame:
    """Per row: the columns in ``carry``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``char_distance``,
    ``word_distance`` (null where a text is too short to judge) and ``kept``.

    Null and empty texts have no words and fail. Rows are independent, so
    repeated rows repeat their results; a null language is a language of its
    own, ``und``. ``references`` (default: those of ``docs``) has one row for
    each language, and is joined as Spark finds best from its written size;
    a language that it lacks is not judged by distance.
    """
    if references is None:
        references = language_references(docs, text_col, lang_col)
    references = keep(references, "quality-references")
    hidden = {c: f"__carried_{k}" for k, c in enumerate(carry)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in hidden.items()],
                       F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("__lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    rows = _class_counts(rows).withColumn("ws", F.expr(f"filter(split(__text, {_sql(_BLANK)}), w -> w <> '')"))
    w = WINDOW_WORDS
    window = "xxhash64(" + ", ".join(f"ws[i + {k}]" for k in range(w)) + ")"
    rows = rows.withColumn("windows", F.expr(
        f"IF(size(ws) < {w}, array(), transform(sequence(0, greatest(size(ws) - {w}, 0)), i -> {window}))"))
    # places of windows found twice or more; most texts have none and are not sorted
    rows = rows.withColumn("by_window", F.expr(
        "IF(size(array_distinct(windows)) = size(windows), array(), "
        "sort_array(transform(windows, (h, i) -> struct(h, i))))"))
    rows = rows.withColumn("twice", F.expr(
        "sort_array(filter(transform(by_window, (x, i) -> IF(by_window[greatest(i - 1, 0)].h = x.h AND i > 0 "
        "OR by_window[least(i + 1, size(by_window) - 1)].h = x.h AND i < size(by_window) - 1, x.i, -1)), i -> i >= 0))"))
    repeat = (f"IF(size(twice) = 0, 0L, aggregate(twice, struct(0L AS n, {-w} AS at), "
              f"(s, i) -> struct(s.n + least({w}, i - s.at) AS n, i AS at), s -> s.n))")
    rows = rows.withColumn("lines", F.expr(f"filter(split(__text, '\\n'), l -> l RLIKE {_sql('[^ \\x09-\\x0D]')})"))
    rows = rows.join(references, "__lang", "left")
    # the common words alone, with blanks doubled, so that each has its own on both sides
    rows = rows.withColumn("spaced", F.expr(
        f"IF(size(ws) >= {LEAST_COMMON_WORDS}, concat(' ', lower(array_join(filter(ws, w -> array_contains(common, lower(w))), '  ')), ' '), '')"))
    found = "(octet_length(spaced) - octet_length(replace(spaced, concat(' ', w, ' '), ''))) div (octet_length(w) + 2)"
    rows = rows.selectExpr(
        *[f"`{n}`" for n in hidden.values()], "classes", "class_share", "word_share",
        "cast(size(ws) AS bigint) AS n_words", f"cast(length(__text) - classes[1] AS bigint) AS word_chars",
        f"cast(classes[{SYMBOLS}] AS bigint) AS n_symbols",
        "cast(size(lines) - size(array_distinct(lines)) AS bigint) AS n_dup_lines", f"{repeat} AS n_repeat_words",
        f"IF(size(ws) >= {LEAST_COMMON_WORDS}, transform(common, w -> {found}), NULL) AS found",
        "cast(length(__text) AS bigint) AS n_chars")
    rows = rows.withColumn("char_distance", F.expr(
        f"IF(n_chars >= {LEAST_CHARS} AND class_share IS NOT NULL, sqrt(greatest(0D, aggregate(zip_with(classes, class_share, (c, q) -> "
        f"{_divergence('(c / n_chars)', 'q')}), 0D, (s, x) -> s + x))), NULL)"))
    other = _divergence("(1 - aggregate(found, 0L, (s, x) -> s + x) / n_words)", "greatest(0D, 1 - aggregate(word_share, 0D, (s, x) -> s + x))")
    rows = rows.withColumn("word_distance", F.expr(
        f"IF(n_words >= {LEAST_COMMON_WORDS} AND word_share IS NOT NULL, sqrt(greatest(0D, aggregate(zip_with(found, word_share, (c, q) -> "
        f"{_divergence('(c / n_words)', 'q')}), 0D, (s, x) -> s + x) + {other})), NULL)"))
    rows = rows.withColumn("base_failed", F.expr(
        f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"))
    far = (f"coalesce(char_distance > {CHAR_DISTANCE} + sqrt({len(CLASSES)} / n_chars), false) OR "
           f"coalesce(word_distance > {WORD_DISTANCE} + sqrt({COMMON} / (8 * n_words)), false)")
    return rows.withColumn("kept", F.expr(f"NOT base_failed AND NOT ({far})")).select(
        *[F.col(n).alias(c) for c, n in hidden.items()], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "char_distance", "word_distance", "kept")


def _oracle() -> str:
    """The same result from one row for each word, window and line."""
    left, counts = ["t"], []
    for k, c in enumerate(CLASSES):
        left.append(f"l{k}")
    chain = "d"
    for k, c in enumerate(CLASSES):
        chain = f"(SELECT *, regexp_replace({left[k]}, '{c.replace(chr(39), chr(39) * 2)}+', '', 'g') AS l{k} FROM {chain})"
    counts = [f"length({a}) - length({b})" for a, b in zip(left, left[1:])] + [f"length({left[-1]})"]
    n = len(counts)

    def part(p, q):
        half = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) / 2 ELSE 0 END"
        return f"({half.format(p, q)} + {half.format(q, p)})"
    chars = " + ".join(part(f"(c{k} / length(t))", f"(s{k} / greatest(s, 1))") for k in range(n))
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents),
c AS (SELECT id, doc_id, lang, t, {', '.join(f'{x} AS c{k}' for k, x in enumerate(counts))} FROM {chain}),
cr AS (SELECT lang, {', '.join(f'sum(c{k}) AS s{k}' for k in range(n))}, {' + '.join(f'sum(c{k})' for k in range(n))} AS s FROM c GROUP BY lang),
ws AS (SELECT id, lang, list_filter(string_split_regex(t, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d),
w AS (SELECT id, lang, unnest(list_transform(ws, lambda x: lower(x))) AS w FROM ws),
lw AS (SELECT lang, w, count(*) AS n FROM w GROUP BY ALL),
tot AS (SELECT lang, sum(n) AS total FROM lw GROUP BY lang),
top AS (SELECT lang, w, n / total AS q FROM lw JOIN tot USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) <= {COMMON}),
tops AS (SELECT lang, sum(q) AS q FROM top GROUP BY lang),
dw AS (SELECT id, lang, w, count(*) AS c FROM w GROUP BY ALL),
h AS (SELECT dw.id, sum(c) AS c, sum(q) AS q, sum({part('(dw.c / len(ws.ws))', 'q')}) AS v
  FROM dw JOIN ws USING (id) JOIN top ON top.lang = dw.lang AND top.w = dw.w GROUP BY dw.id),
g AS (SELECT id, unnest(range(1, len(ws) - {WINDOW_WORDS - 2})) AS i, unnest(list_transform(range(1, len(ws) - {WINDOW_WORDS - 2}),
    lambda i: array_to_string(ws[i:i + {WINDOW_WORDS - 1}], ' '))) AS g FROM ws WHERE len(ws) >= {WINDOW_WORDS}),
r AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(i, i + {WINDOW_WORDS})) AS p
  FROM (SELECT * FROM g QUALIFY count(*) OVER (PARTITION BY id, g) > 1)) GROUP BY id),
ln AS (SELECT id, count(*) - count(DISTINCT l) AS n FROM (SELECT id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^ \\x09-\\x0D]') GROUP BY id),
o AS (SELECT c.doc_id, length(t) AS n_chars, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(t) - c1 AS BIGINT) AS word_chars,
    CAST(c{SYMBOLS} AS BIGINT) AS n_symbols, coalesce(ln.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    CASE WHEN length(t) >= {LEAST_CHARS} THEN sqrt(greatest(0, {chars})) END AS char_distance,
    CASE WHEN len(ws) >= {LEAST_COMMON_WORDS} THEN sqrt(greatest(0, coalesce(h.v, 0) + (tops.q - coalesce(h.q, 0)) / 2
      + {part('(1 - coalesce(h.c, 0) / len(ws))', 'greatest(0, 1 - tops.q)')})) END AS word_distance
  FROM c JOIN ws USING (id) JOIN cr ON cr.lang = c.lang LEFT JOIN tops ON tops.lang = c.lang
  LEFT JOIN h USING (id) LEFT JOIN r USING (id) LEFT JOIN ln USING (id)),
e AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
  AND NOT coalesce(char_distance > {CHAR_DISTANCE} + sqrt({len(CLASSES)} / n_chars), false)
  AND NOT coalesce(word_distance > {WORD_DISTANCE} + sqrt({COMMON} / (8 * n_words)), false) AS kept
FROM e
"""


ORACLE = _oracle()
