"""Chat formatting in budgeted windows.

A conversation is cut into windows of whole turns. Prefix sums of the turns'
token counts decide which window a turn belongs to; every window repeats the
system turn and up to two turns of history, and only assistant turns that are
not repeated are targets of the loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window and, within them, of repeated history. A token is about four bytes.
BUDGET, HISTORY = 1024, 256
BYTES_PER_TOKEN, TURN_TOKENS = 4, 4


def _escaped(text: str) -> str:
    """SQL: text without ``<`` and ``>``, so that it can hold no mark of the template."""
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _plain(text: str) -> str:
    """SQL: the text before escaping."""
    return f"replace(replace(replace({text}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


def format_conversations(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row for each window: ``conv_id``, ``window``, ``text``, ``copies``
    (leading turns that repeat earlier ones), ``loss`` (code point spans of the
    targets in ``text``) and ``n_tokens``.

    A turn is written ``<role>text</s>`` with ``&``, ``<`` and ``>`` escaped
    as in HTML, which is undone without loss. The room of a window is ``budget``
    less the system turn and the history (a quarter of the budget at least).
    Turns that start in the same half of a room share a window, but one of more
    than half a room has its own, so no window is over ``budget`` unless one turn,
    or the system turn, is too long for it by itself; nothing is cut. Only a
    leading system turn is retained. Null roles and texts count as empty; a null
    conv_id is a conversation; rows of one turn number stand in order of role and
    text, repeated rows repeat the turn.

    Sums run along a conversation in sorted order and keep no rows; only the
    turns of one window are gathered.
    """
    made = conversations.selectExpr("conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text").selectExpr(
        "conv_id", "turn", "role", "text", f"concat('<', {_escaped('role')}, '>') AS mark", f"{_escaped('text')} AS body",
        f"cast(ceil(octet_length(text) / {BYTES_PER_TOKEN}) AS bigint) + {TURN_TOKENS} AS tokens")
    along = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = made.withColumn("n", F.row_number().over(along)).withColumn("total", F.sum("tokens").over(so_far))
    made = made.withColumn("system", F.expr("n = 1 AND role = 'system'"))
    made = made.withColumn("system_turn", F.first(F.when(F.col("system"), F.struct("mark", "body", "tokens"))).over(so_far))
    made = made.withColumn("room", F.expr(
        f"greatest({budget} - {history} - coalesce(system_turn.tokens, 0), {budget} div 4)"))
    made = made.withColumn("own", F.expr(
        "2 * ((total - tokens - coalesce(system_turn.tokens, 0)) div (room div 2)) + IF(tokens > room div 2, 1, 0)"))
    made = made.withColumn("again", F.expr(f"greatest(0, least({history}, {budget} - room - coalesce(system_turn.tokens, 0)))"))
    made = made.withColumn("next_own", F.lead("own", 1).over(along)).withColumn("window", F.expr(
        "IF(system, coalesce(next_own, 0), own)"))
    made = made.withColumn("w1", F.lead("window", 1).over(along)).withColumn(
        "w2", F.lead("window", 2).over(along)).withColumn("w0", F.lag("window", 1).over(along)).withColumn(
        "t1", F.lead("tokens", 1).over(along))
    entry = "named_struct('window', {0}, 'place', {1}, 'copy', {2}, 'target', {3}, 'mark', {4}, 'body', {5}, 'tokens', {6})"
    own = entry.format("window", "n", "false", "role = 'assistant'", "mark", "body", "tokens")
    again = entry.format("{0}", "n", "true", "false", "mark", "body", "tokens")
    system = entry.format("window", "0", "true", "false", "system_turn.mark", "system_turn.body", "system_turn.tokens")
    rows = made.select("conv_id", F.expr(
        f"filter(array({own}, "
        f"IF(NOT system AND w1 <> window AND tokens <= again, {again.format('w1')}, NULL), "
        f"IF(NOT system AND w2 <> w1 AND tokens + t1 <= again, {again.format('w2')}, NULL), "
        "IF(w0 <> window AND system_turn IS NOT NULL, " + system + ", NULL)), x -> x IS NOT NULL)").alias("made"))
    rows = rows.select("conv_id", F.explode("made").alias("e")).select("conv_id", "e.*")
    turns = rows.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(
        F.struct("place", "copy", "target", "mark", "body", "tokens"))).alias("t"))
    before = "aggregate(slice(t, 1, i), 0, (s, x) -> s + length(x.mark) + length(x.body) + 4)"
    return turns.selectExpr(
        "conv_id", "window", "array_join(transform(t, x -> concat(x.mark, x.body, '</s>')), '') AS text",
        "size(filter(t, x -> x.copy)) AS copies",
        "transform(filter(sequence(0, size(t) - 1), i -> t[i].target), i -> named_struct("
        f"'start', {before} + length(t[i].mark), 'end', {before} + length(t[i].mark) + length(t[i].body))) AS loss",
        "aggregate(t, 0L, (s, x) -> s + x.tokens) AS n_tokens")


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the formatted windows alone: ``n_turns``, digests of
    the turns and of the text under the loss mask, and lengths."""
    pattern = "'<([^>]*)>([^<]*)</s>'"
    parsed = windows.selectExpr(
        "conv_id", "window", "text", "copies", "loss",
        f"zip_with(regexp_extract_all(text, {pattern}, 1), regexp_extract_all(text, {pattern}, 2), "
        "(r, b) -> named_struct('role', r, 'body', b)) AS t")
    parsed = parsed.selectExpr("conv_id", "window", "text", "loss", "slice(t, copies + 1, size(t)) AS t").selectExpr(
        "conv_id", "window", "length(text) AS chars", "size(t) AS n",
        f"array_join(transform(t, x -> concat({_plain('x.role')}, '\\n', {_plain('x.body')}, '\\n')), '') AS turns",
        "array_join(transform(loss, x -> " + _plain("substring(text, x.start + 1, x.end - x.start)") + "), '') AS target")
    whole = parsed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "target"))).alias("w"),
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    return whole.selectExpr(
        "conv_id", "n_turns", "sha2(array_join(w.turns, ''), 256) AS turns_sha256",
        "cast(length(array_join(w.target, '')) AS bigint) AS loss_chars",
        "sha2(array_join(w.target, ''), 256) AS loss_sha256", "formatted_chars")


#: The same result by window functions over plain turns.
ORACLE = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + length(role) + 6
    + 4 * (length(text) - length(replace(text, '&', ''))) + 3 * (length(text) - length(replace(replace(text, '<', ''), '>', '')))
    + 4 * (length(role) - length(replace(role, '&', ''))) + 3 * (length(role) - length(replace(replace(role, '<', ''), '>', '')))
      AS chars,
    CAST(ceil(strlen(text) / {BYTES_PER_TOKEN}) AS BIGINT) + {TURN_TOKENS} AS tokens FROM c),
n AS (SELECT *, row_number() OVER w AS n, sum(tokens) OVER (w ROWS UNBOUNDED PRECEDING) AS total FROM e
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, n = 1 AND role = 'system' AS system,
    coalesce(max(CASE WHEN n = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS st,
    max(CASE WHEN n = 1 AND role = 'system' THEN chars END) OVER (PARTITION BY conv_id) AS sc FROM n),
v AS (SELECT *, greatest({BUDGET} - {HISTORY} - st, {BUDGET} // 4) AS room FROM s),
o AS (SELECT *, 2 * ((total - tokens - st) // (room // 2)) + CASE WHEN tokens > room // 2 THEN 1 ELSE 0 END AS own,
    greatest(0, least({HISTORY}, {BUDGET} - room - st)) AS again FROM v),
p AS (SELECT *, CASE WHEN system THEN coalesce(lead(own) OVER (PARTITION BY conv_id ORDER BY n), 0) ELSE own END AS win FROM o),
l AS (SELECT *, lead(win) OVER w AS w1, lead(win, 2) OVER w AS w2, lag(win) OVER w AS w0, lead(tokens) OVER w AS t1 FROM p
  WINDOW w AS (PARTITION BY conv_id ORDER BY n))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN NOT system AND w1 <> win AND tokens <= again THEN chars ELSE 0 END
    + CASE WHEN NOT system AND w2 <> w1 AND tokens + t1 <= again THEN chars ELSE 0 END
    + CASE WHEN w0 <> win THEN coalesce(sc, 0) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""
