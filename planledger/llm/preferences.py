"""Preference formatting: one prompt and two masked completions per pair of conversations.

The prompt is the longest common prefix of the chosen and the rejected
conversation's turns (role and text equal), rendered once. What follows on each
side is rendered as its completion, with the code point spans that training
counts: text and end mark of the turns of trained roles. All on DataFrame functions, with one
shuffle by pair.

Turns are ordered by turn, then role, then text; repeated rows are turns of their
own. Null roles and texts count as empty. Rows without pair or side are ignored. A
pair with one side has the empty conversation on the other, hence no prompt.
A conversation is one training example and is gathered whole.
Extra columns are not carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = ("assistant",)


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), "")


def _trained_spans(turns: str, roles: tuple[str, ...]) -> Column:
    """(start, end) of what counts within the rendered ``turns``; the line break behind the end mark doesn't."""
    names = ", ".join("'" + r.replace("\\", "\\\\").replace("'", "\\'") + "'" for r in roles) or "null"
    head, tail = len(OPEN) + len(CLOSE), len(END)
    return F.expr(f"""aggregate({turns},
        named_struct('at', cast(0 as bigint), 'spans', cast(array() as array<struct<start:bigint,end:bigint>>)),
        (a, t) -> named_struct(
            'at', a.at + length(t.role) + length(t.text) + {head + tail},
            'spans', if(coalesce(t.role in ({names}), false), concat(a.spans, array(named_struct(
                'start', a.at + length(t.role) + {head},
                'end', a.at + length(t.role) + length(t.text) + {head + tail - 1}))), a.spans)),
        a -> a.spans)""")


def format_preferences(
    turns: DataFrame, pair: str = "pair_id", side: str = "side", trained: tuple[str, ...] = TRAINED
) -> DataFrame:
    """(pair, n_prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans).

    ``turns`` has pair, side ('chosen' or 'rejected'), turn, role and text.
    """
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sides = [F.sort_array(F.collect_list(F.when(F.col(side) == name, one))).alias(f"__{name}") for name in ("chosen", "rejected")]
    both = turns.filter(F.col(pair).isNotNull() & F.col(side).isin("chosen", "rejected")).groupBy(pair).agg(*sides)
    shared = F.expr("""if(least(size(__chosen), size(__rejected)) = 0, 0, coalesce(
        array_min(filter(sequence(0, least(size(__chosen), size(__rejected)) - 1), i ->
            get(__chosen, i).role <> get(__rejected, i).role or get(__chosen, i).text <> get(__rejected, i).text)),
        least(size(__chosen), size(__rejected))))""")
    cut = both.withColumn("__n", shared)
    rest = cut.withColumns({
        "__prompt": F.slice("__chosen", F.lit(1), F.col("__n")),
        "__c": F.slice("__chosen", F.col("__n") + 1, F.size("__chosen")),
        "__r": F.slice("__rejected", F.col("__n") + 1, F.size("__rejected")),
    })
    return rest.select(
        pair,
        F.col("__n").cast("long").alias("n_prompt_turns"),
        _render(F.col("__prompt")).alias("prompt"),
        _render(F.col("__c")).alias("chosen"),
        _trained_spans("__c", trained).alias("chosen_spans"),
        _render(F.col("__r")).alias("rejected"),
        _trained_spans("__r", trained).alias("rejected_spans"),
    )


def mismatched_replies(said: DataFrame, role: str = TRAINED[0]) -> DataFrame:
    """(pair_id, side, turn, role, text) from conversations (conv_id, turn, role, text) that carry
    no preferences: a conversation up to its last reply is chosen, and rejected is the same with
    the last reply of its neighbour (2p for 2p + 1 and back) in place of its own.

    Conversations without reply make no pair; without a neighbour's reply nothing takes its place.
    """
    own = said.filter("conv_id is not null and turn is not null").select("conv_id", "turn", "role", "text")
    last = F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("reply"))).alias("last")
    replies = own.filter(F.col("role") == role).groupBy("conv_id").agg(last).select("conv_id", F.col("last.turn").alias("last_turn"), "last.reply")
    upto = own.join(replies.select("conv_id", "last_turn"), "conv_id").filter("turn <= last_turn")
    others = replies.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("text"))
    swapped = replies.join(others, "conv_id").select("conv_id", F.col("last_turn").alias("turn"), F.lit(role).alias("role"), "text")
    chosen = upto.drop("last_turn").withColumn("side", F.lit("chosen"))
    rejected = upto.filter("turn < last_turn").drop("last_turn").unionByName(swapped).withColumn("side", F.lit("rejected"))
    return chosen.unionByName(rejected).withColumnRenamed("conv_id", "pair_id")


#: ``format_preferences(mismatched_replies(conversations))`` as SQL, with digests of the texts.
PREFERENCES_SQL = """
WITH replies AS (SELECT conv_id, turn AS last_turn, coalesce(text, '') AS reply FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, coalesce(text, '') DESC) AS k FROM conversations
    WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL) WHERE k = 1),
upto AS (SELECT c.conv_id, turn, role, text, last_turn FROM conversations c JOIN replies USING (conv_id) WHERE turn <= last_turn),
turns AS (SELECT conv_id AS pair_id, 0 AS side, turn, role, text FROM upto
          UNION ALL SELECT conv_id, 1, turn, role, text FROM upto WHERE turn < last_turn
          UNION ALL SELECT a.conv_id, 1, a.last_turn, 'assistant', b.reply FROM replies a JOIN replies b ON b.conv_id = xor(a.conv_id, 1)),
t AS (SELECT pair_id, side, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS i FROM turns),
met AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.i, r.i) AS i,
               coalesce(c.role = r.role AND c.text = r.text, false) AS same
        FROM (SELECT * FROM t WHERE side = 0) c FULL JOIN (SELECT * FROM t WHERE side = 1) r ON c.pair_id = r.pair_id AND c.i = r.i),
shared AS (SELECT pair_id, coalesce(min(i) FILTER (WHERE NOT same), max(i) + 1) - 1 AS n FROM met GROUP BY pair_id),
said AS (SELECT t.*, n, i > n AS after, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line
         FROM t JOIN shared USING (pair_id)),
placed AS (SELECT *, sum(length(line)) OVER (PARTITION BY pair_id, side, after ORDER BY i) - length(line) + length(role) + 5 AS start FROM said)
SELECT pair_id, n AS n_prompt_turns,
       md5(coalesce(string_agg(line, '' ORDER BY i) FILTER (WHERE side = 0 AND NOT after), '')) AS prompt_md5,
       md5(coalesce(string_agg(line, '' ORDER BY i) FILTER (WHERE side = 0 AND after), '')) AS chosen_md5,
       md5(coalesce(string_agg(line, '' ORDER BY i) FILTER (WHERE side = 1 AND after), '')) AS rejected_md5,
       coalesce(string_agg(start::BIGINT || ':' || (start + length(text) + 7)::BIGINT, ',' ORDER BY i)
                FILTER (WHERE side = 0 AND after AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(start::BIGINT || ':' || (start + length(text) + 7)::BIGINT, ',' ORDER BY i)
                FILTER (WHERE side = 1 AND after AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY pair_id, n
"""
