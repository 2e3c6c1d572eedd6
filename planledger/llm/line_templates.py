"""Line dedup by a log-template tree, on DataFrame functions only.

A line's tokens (by single spaces) are parsed at fixed depth: tokens with a digit
become ``<*>``; the token count and the first ``depth`` tokens give its leaf. In a
leaf, a token that fewer than ``min_docs`` documents have at its place is a
variable field and generalises to ``<*>`` as well, so long as at least
``similarity`` of the line stays constant; otherwise the line is its own template.
A token must also be as common as its line: the documents it has at its place are at
least ``share`` of those of the line's usual token, the one down to which ``similarity``
of the line is more common. For lines of one template that is about the template's own
number of documents, however many other templates share the leaf, so that the values of a
field stay variable when the corpus grows and each of them reaches ``min_docs``.
A template that occurs in at least ``min_docs`` documents recurs: its lines stay
in the document with the smallest key and are dropped from all others. A line of
``long_tokens`` tokens or more recurs by itself from two documents on, if it is the
same in them after masking.

Leaves, lines and templates are counted with partial aggregates, each line once
per document. Lines that differ only in masked tokens are one row from then on.
Text is shuffled twice: the lines of leaves that hold several lines and enough
documents, and the documents when their lines are dropped. All joins of lines,
where one line may hold a third of all rows, can be split by adaptive execution.

Null and empty texts stay as they are, and blank lines and lines of fewer than
``min_tokens`` tokens are never dropped. Rows without key take no part and stay.
Rows with equal key and text are one document. Extra columns stay; ``n_lines`` and
``n_dropped`` are replaced if there. A text all of whose lines go becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from planledger.llm.storage import saved
from planledger.operators.joins import split_join

#: A token with a digit. Possessive, and tried at token starts only: linear in the line.
_VARIABLE = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def _masked(line: Column) -> Column:
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, _VARIABLE, "<*>")).otherwise(line)


def masked_lines(docs: DataFrame, key: str, text: str, min_tokens: int, depth: int) -> DataFrame:
    """(doc, text_hash, pos, masked, n, leaf, line) of every line long enough."""
    # Below the generator, or the whole text would be hashed again for each of its lines.
    whole = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("raws")
    )
    rows = whole.select("doc", "text_hash", F.posexplode("raws").alias("pos", "raw"))
    # Masking keeps the number of tokens, so short lines go before it.
    blanks = F.octet_length("raw") - F.octet_length(F.replace(F.col("raw"), F.lit(" "), F.lit("")))
    return (
        rows.withColumn("n", blanks + 1)
        .filter((F.col("n") >= min_tokens) & (F.trim("raw") != ""))
        .withColumn("masked", _masked(F.col("raw")))
        .withColumn("leaf", F.xxhash64("n", F.substring_index("masked", " ", depth)))
        .withColumn("line", F.xxhash64("masked"))
        .drop("raw")
    )


def _joined(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """By sort-merge at any size: the right side grows with the corpus, and hot keys of the
    left side can then be split."""
    return split_join(left, right.hint("merge"), on, how)


def counted_lines(docs: DataFrame, key: str, text: str, min_tokens: int, depth: int, long_tokens: int) -> tuple[DataFrame, DataFrame]:
    """All lines as (doc, text_hash, pos, leaf, line, long), and for each how many documents
    have it (w) and the first of them."""
    lines = masked_lines(docs, key, text, min_tokens, depth).withColumn("long", F.col("n") >= long_tokens)
    index = saved(lines.drop("masked", "n"), "lines")
    once = index.groupBy("leaf", "line", "doc").agg(F.max("long").alias("long"))
    marks = [F.min("doc").alias("first"), F.max("long").alias("long")]
    return index, saved(once.groupBy("leaf", "line").agg(F.count("*").alias("w"), *marks), "counts")


def _common(constant: GroupedData, similarity: float, share: float) -> DataFrame:
    """(leaf, line, template) of lines whose tokens are constant as compared with each other."""
    tokens = F.sort_array(F.collect_list(F.struct("docs", "token")), asc=False)
    held = constant.agg(tokens.alias("held"), F.max("n").alias("n")).filter(F.size("held") >= similarity * F.col("n"))
    usual = held.withColumn("usual", F.element_at("held", F.greatest(F.ceil(similarity * F.col("n")), F.lit(1)).cast("int"))["docs"])
    common = F.filter("held", lambda t: t["docs"] >= share * F.col("usual"))
    return usual.select("leaf", "line", F.xxhash64("leaf", common).alias("template"))


def template_lines(
    docs: DataFrame, index: DataFrame, counts: DataFrame,
    key: str, text: str, min_docs: int, min_tokens: int, depth: int, similarity: float, share: float,
) -> DataFrame:
    """(doc, text_hash, pos, template) of the lines in leaves with enough documents."""
    leaves = counts.groupBy("leaf").agg(F.sum("w").alias("docs"), F.count("*").alias("lines")).filter(F.col("docs") >= min_docs)
    leaves = saved(leaves.select("leaf", "lines"), "leaves")

    # Leaves that hold one line have nothing to generalise.
    wide = leaves.filter("lines > 1").select("leaf")
    whole = masked_lines(docs, key, text, min_tokens, depth).select("leaf", "line", "n", "masked")
    texts = _joined(whole, wide, "leaf").groupBy("leaf", "line").agg(F.max("n").alias("n"), F.max("masked").alias("masked"))
    tokens = (
        texts.join(counts.select("leaf", "line", "w"), ["leaf", "line"])
        .select("leaf", "line", "n", "w", F.posexplode(F.split("masked", " ")).alias("place", "token"))
        .withColumn("token", F.xxhash64("place", "token"))
        .drop("place")
    )
    tokens = saved(tokens, "tokens")
    fixed = tokens.groupBy("leaf", "token").agg(F.sum("w").alias("docs")).filter(F.col("docs") >= min_docs)
    constant = _joined(tokens, fixed, ["leaf", "token"]).groupBy("leaf", "line")
    general = _common(constant, similarity, share)
    found = _joined(index.select("doc", "text_hash", "pos", "leaf", "line"), leaves.select("leaf"), "leaf")
    return _joined(found, general, ["leaf", "line"], "left").select(
        "doc", "text_hash", "pos", F.coalesce("template", F.xxhash64("leaf", "line")).alias("template")
    )


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_docs: int = 3,
    min_tokens: int = 3,
    depth: int = 3,
    similarity: float = 0.7,
    share: float = 0.5,
    long_tokens: int = 20,
) -> DataFrame:
    """Drop recurring lines from ``text``; adds n_lines and n_dropped."""
    own = docs.drop("n_lines", "n_dropped")
    index, counts = counted_lines(own, key, text, min_tokens, depth, long_tokens)
    lines = saved(template_lines(own, index, counts, key, text, min_docs, min_tokens, depth, similarity, share), "templates")
    holders = lines.groupBy("template", "doc").agg(F.count("*").alias("__c")).drop("__c")
    recurring = (
        holders.groupBy("template").agg(F.count("*").alias("docs"), F.min("doc").alias("first"))
        .filter(F.col("docs") >= min_docs).select("template", "first")
    )
    dropped = _joined(lines, recurring, "template").filter("doc <> first").select("doc", "text_hash", "pos")
    # The first document of a template is also the first of each of its lines.
    repeated = counts.filter("long and w > 1").select("leaf", "line", "first")
    twice = _joined(index.filter("long"), repeated, ["leaf", "line"]).filter("doc <> first")
    dropped = dropped.unionByName(twice.select("doc", "text_hash", "pos"))
    gone = dropped.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("__gone"))
    gone = gone.select(F.col("doc").alias(key), F.col("text_hash").alias("__hash"), "__gone")
    joined = own.withColumn("__hash", F.xxhash64(text)).join(gone.hint("merge"), [key, "__hash"], "left")
    # The generator keeps the optimizer from splitting the text again for every part.
    cut = joined.withColumn("__lines", F.explode(F.array(F.split(text, "\n"))))
    kept = F.expr("""array_join(flatten(transform(sequence(0, size(__gone)), k -> slice(
        __lines,
        if(k = 0, 1, __gone[k - 1] + 2),
        if(k = size(__gone), size(__lines), get(__gone, k)) - if(k = 0, 0, __gone[k - 1] + 1)))), '\n')""")
    some = F.col("__gone").isNotNull()
    return cut.select(
        *[F.when(some, kept).otherwise(F.col(text)).alias(text) if name == text else F.col(name) for name in own.columns],
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(some, F.size("__gone")).otherwise(0).cast("long").alias("n_dropped"),
    )


#: The same over ``documents`` as SQL, with the defaults.
LINE_DEDUP_SQL = """
WITH cut AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw,
                    unnest(range(len(string_split(text, chr(10))))) AS pos
             FROM documents WHERE doc_id IS NOT NULL),
masked AS (SELECT doc_id, text, pos, regexp_replace(raw, '(^| )[^ 0-9]*[0-9][^ ]*', '\\1<*>', 'g') AS line FROM cut),
lines AS (SELECT *, string_split(line, ' ') AS tokens, len(string_split(line, ' ')) AS n,
                 [len(string_split(line, ' '))::VARCHAR] || string_split(line, ' ')[1:3] AS leaf
          FROM masked WHERE len(string_split(line, ' ')) >= 3 AND trim(line, ' ') <> ''),
counts AS (SELECT leaf, line, any_value(tokens) AS tokens, any_value(n) AS n, count(DISTINCT doc_id) AS w
           FROM lines GROUP BY leaf, line),
leaves AS (SELECT leaf, count(*) AS m FROM counts GROUP BY leaf HAVING sum(w) >= 3),
tokens AS (SELECT leaf, line, n, w, unnest(tokens) AS token, unnest(range(n)) AS place
           FROM counts JOIN leaves USING (leaf) WHERE m > 1),
fixed AS (SELECT leaf, place, token, sum(w) AS docs FROM tokens GROUP BY ALL HAVING sum(w) >= 3),
usual AS (SELECT leaf, line, list(docs ORDER BY docs DESC)[greatest(ceil(0.7::DOUBLE * n), 1)::INT] AS usual
          FROM tokens JOIN fixed USING (leaf, place, token)
          GROUP BY leaf, line, n HAVING count(*) >= 0.7::DOUBLE * n),
general AS (SELECT leaf, line, list((place, token) ORDER BY place) AS shape
            FROM tokens JOIN fixed USING (leaf, place, token) JOIN usual USING (leaf, line)
            WHERE docs >= 0.5 * usual GROUP BY leaf, line),
placed AS (SELECT l.doc_id, l.text, l.pos, l.leaf, g.shape, CASE WHEN g.shape IS NULL THEN l.line END AS own
           FROM lines l JOIN leaves USING (leaf) LEFT JOIN general g ON g.leaf = l.leaf AND g.line = l.line),
recurring AS (SELECT leaf, shape, own, min(doc_id) AS first FROM placed GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
repeated AS (SELECT leaf, line, min(doc_id) AS first FROM lines WHERE n >= 20 GROUP BY leaf, line HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT p.doc_id, p.text, p.pos FROM placed p JOIN recurring r
         ON p.leaf = r.leaf AND p.shape IS NOT DISTINCT FROM r.shape AND p.own IS NOT DISTINCT FROM r.own
         WHERE p.doc_id <> r.first
         UNION SELECT l.doc_id, l.text, l.pos FROM lines l JOIN repeated r USING (leaf, line) WHERE l.doc_id <> r.first),
kept AS (SELECT c.doc_id, c.text, string_agg(c.raw, chr(10) ORDER BY c.pos) FILTER (WHERE g.pos IS NULL) AS rest, count(g.pos) AS n_dropped
         FROM (SELECT DISTINCT * FROM cut) c LEFT JOIN gone g USING (doc_id, text, pos) GROUP BY c.doc_id, c.text)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(k.n_dropped, 0)::BIGINT AS n_dropped,
       md5(CASE WHEN coalesce(k.n_dropped, 0) = 0 THEN d.text ELSE coalesce(k.rest, '') END) AS text_md5
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text
"""
