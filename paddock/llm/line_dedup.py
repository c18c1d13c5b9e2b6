"""Removing repeated runs of lines, by prefix doubling over the lines of all documents.

The non-blank lines of all documents, in order of document and line, are the text; its letters are the line classes.
The rank of a position at level k names the class of all positions that are followed by the same 2^k lines: it is the
first such position. Level 0 is found by grouping equal lines; level k + 1 by grouping the pair of the ranks at the position
and 2^k lines further. A class with two or more positions is an interval of suffixes with a common prefix of at least
2^k lines; other positions leave the doubling. Two ranks that overlap name a run of any length, so that equal runs are
found by grouping (length, rank at the start, rank that ends with the run).

A run of lines is repeated if the same lines stand elsewhere and they have at least `min_words` words together. The
shortest such runs from each line on, and those up to each line, cover exactly the lines of all maximal repeated runs,
so only these are looked up: they have at most `min_words` lines, which bounds the doubling. All but the first copy of
a run are deleted. Shorter runs meet by chance; but a run that stands `min_copies` times or more is repeated whatever its
length. Each of its lines stands as often, so the classes of single lines say which.

Only DataFrame functions are used. Every step that could meet a hot class aggregates it first and joins the one row back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paddock.llm.common import stored, text_or_empty

TEXT_HASH = "__text_hash"
RANGES = "__ranges"
LINES = "__lines"
# White space besides the space, and letters of scripts written without spaces by how many make up a word.
OTHER_SPACE = r"\t\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
UNSPACED = {2: r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}", 4: r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"}
UNBROKEN = 64  # other characters without white space, more than a long word has, that count as a further word


def _words(line: str) -> str:
    """SQL for the number of words of a line: what single spaces separate, what runs of other white space separate, and
    more for text without any."""
    space = f"[{OTHER_SPACE}]"
    letters = [f"length(regexp_replace({line}, r'[^{x}]', '')) div {n}" for n, x in UNSPACED.items()]
    # Few lines have any of what the slow expressions count, so a quick one is asked first.
    return rf"""CAST(1 + length(trim({line})) - length(replace(trim({line}), ' ', '')) + CASE
        WHEN {line} RLIKE r'[\t\x0B\f\r\x{{85}}\x{{A0}}\x{{E00}}-\x{{10FFFF}}]' OR {line} RLIKE r'[^ ]{{{UNBROKEN}}}' THEN
          regexp_count({line}, r'(?<=[^ {OTHER_SPACE}]){space}++(?=[^ {OTHER_SPACE}])')
          + regexp_count({line}, r'[^ {OTHER_SPACE}{"".join(UNSPACED.values())}]{{{UNBROKEN}}}') + {' + '.join(letters)}
        ELSE 0 END AS BIGINT)"""


def _positions(docs: DataFrame, min_words: int, id_column: str, text_column: str) -> DataFrame:
    """The non-blank lines of all documents in order, without their text.

    p is the position (p - i is the document's first), i the number among the document's non-blank lines, [line,
    next_line) the lines of the text that go with it, h1 and h2 a hash of 128 bits; ahead and back are the number of
    lines of the shortest runs of min_words words that begin and end here, null if there is none.
    """
    lines = F.expr(f"""
        transform(
          filter(transform(lines, (x, j) -> struct(x AS text, j AS line)), s -> trim(s.text) <> ''),
          (s, i) -> struct(i, s.line AS line, xxhash64(s.text) AS h1, xxhash64(s.text, 1) AS h2,
            {_words("s.text")} AS words))""")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(text_or_empty(text_column)).alias("text_hash"),
                       F.split(text_or_empty(text_column), "\n").alias("lines"))
    rows = rows.select("id", "text_hash", F.size("lines").alias("n_lines"), F.inline(lines))
    # One exchange serves the order of positions, the repeated rows and the windows over a document.
    rows = rows.repartitionByRange("id", "text_hash").dropDuplicates(["id", "text_hash", "i"])
    doc = Window.partitionBy("id", "text_hash")
    in_order = doc.orderBy("i")
    rows = rows.withColumn("until", F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "next_line", F.coalesce(F.lead("line").over(in_order), F.col("n_lines"))).withColumn(
        "total", F.sum("words").over(doc)).withColumn("since", F.col("until") - F.col("words"))
    rows = rows.withColumn("ahead", F.when(
        F.col("total") - F.col("since") >= min_words,
        F.count("*").over(doc.orderBy("since").rangeBetween(0, min_words - 1)))).withColumn("back", F.when(
            F.col("until") >= min_words, F.count("*").over(doc.orderBy("until").rangeBetween(1 - min_words, 0))))
    rows = rows.sortWithinPartitions("id", "text_hash", "i")
    return stored(rows.select(
        F.monotonically_increasing_id().alias("p"), "id", "text_hash", F.col("i").cast("long").alias("i"), "line",
        "next_line", "h1", "h2", "ahead", "back"))


def _classes(rows: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """The rank (first position) of every class that has two or more positions."""
    return rows.groupBy(*keys).agg(F.min("p").alias(rank), F.count("*").alias("members")).where("members > 1").drop("members")


def _ranks(positions: DataFrame, levels: int) -> list[DataFrame]:
    """For each level k the positions (p, i) in classes of two or more, with their rank r and what is needed later."""
    rows = positions.select("p", "i", "h1", "h2", "ahead", "back")
    lines = rows.groupBy("h1", "h2").agg(F.min("p").alias("r"), F.count("*").alias("members")).where("members > 1")
    level = stored(rows.join(lines, ["h1", "h2"]).drop("h1", "h2"))
    found = [level]
    for k in range(levels):
        further = Window.partitionBy(F.col("p") - F.col("i")).orderBy("p").rangeBetween(1 << k, 1 << k)
        pairs = level.select("p", "i", "r", F.first("r").over(further).alias("r2")).where("r2 IS NOT NULL")
        pairs = stored(pairs)
        level = stored(pairs.join(_classes(pairs, ["r", "r2"], "rank"), ["r", "r2"]).select("p", "i", F.col("rank").alias("r")))
        found.append(level)
    return found


def repeated_ranges(
    docs: DataFrame, min_words: int = 10, id_column: str = "doc_id", text_column: str = "text", min_copies: int = 8,
) -> DataFrame:
    """id, text_hash and ranges [from, to) of lines to delete, for every document that has such lines."""
    positions = _positions(docs, min_words, id_column, text_column)
    longest = positions.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 1  # at most min_words
    levels = int(longest).bit_length() - 1
    ranks = _ranks(positions, levels)
    first = ranks[0]
    wanted = first.where("ahead IS NOT NULL").select("p", F.col("ahead").alias("n")).unionAll(
        first.where("back IS NOT NULL").select((F.col("p") - F.col("back") + 1).alias("p"), F.col("back").alias("n")))
    level = F.lit(0)
    for k in range(1, levels + 1):
        level = F.when(F.col("n") >= 1 << k, k).otherwise(level)
    wanted = wanted.distinct().withColumn("k", level)
    wanted = wanted.withColumn("q", F.expr("p + n - shiftleft(1L, k)"))
    by_level = None
    for k, table in enumerate(ranks):
        part = table.select(F.lit(k).alias("k"), F.col("p"), F.col("r"))
        by_level = part if by_level is None else by_level.unionAll(part)
    runs = wanted.join(by_level.withColumnRenamed("r", "ra"), ["k", "p"]).join(
        by_level.select("k", F.col("p").alias("q"), F.col("r").alias("rb")), ["k", "q"])
    runs = stored(runs.select("p", "n", "ra", "rb"))
    later = runs.join(_classes(runs, ["n", "ra", "rb"], "first"), ["n", "ra", "rb"]).where("p <> first")
    frequent = first.where((F.col("members") >= min_copies) & (F.col("p") != F.col("r"))).select("p")
    gone = later.select(F.explode(F.expr("sequence(p, p + n - 1)")).alias("p")).unionAll(frequent).distinct()
    gone = gone.join(positions.select("p", "i", "id", "text_hash", "line", "next_line"), "p")
    doc = Window.partitionBy("id", "text_hash").orderBy("i")
    islands = gone.withColumn("island", F.col("i") - F.row_number().over(doc)).groupBy("id", "text_hash", "island").agg(
        F.min("line").alias("from"), F.max("next_line").alias("to"))
    return islands.groupBy("id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("ranges"))


def dedup_lines(
    docs: DataFrame, min_words: int = 10, id_column: str = "doc_id", text_column: str = "text", min_copies: int = 8,
) -> DataFrame:
    """The rows of `docs` with all their columns, the repeated runs of lines cut out of the text, and n_lines, n_removed, removed.

    Lines end at line feeds and are compared as they are. A blank line goes with the line before it and counts for
    nothing; the words of a line are what single spaces or runs of other white space separate, and where there are none two
    letters (Han, kana) or four (Thai, Lao, Khmer, Burmese, Tibetan) are a word, 64 other characters a further one. Of equal runs the one in the smallest id, then the
    smallest hash of the text, then the first line stays. removed lists the deleted lines as from-to (end exclusive, from 0).
    Runs of fewer than `min_words` words count from `min_copies` copies on (2: every later copy of any line goes). A null text stays null and has no lines. Rows equal in id and text are one document and get the same result; a
    null id sorts first. Columns named n_lines, n_removed, removed in `docs` are replaced.
    """
    ranges = repeated_ranges(docs, min_words, id_column, text_column, min_copies).select(
        F.col("id").alias("__id"), F.col("text_hash").alias(TEXT_HASH), F.col("ranges").alias(RANGES))
    same = F.col(f"`{id_column}`").eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty(text_column)) == F.col(TEXT_HASH))
    rows = docs.join(ranges, same, "left").withColumn(LINES, F.split(F.col(f"`{text_column}`"), "\n"))
    # What lies between the ranges is taken out of the text in one piece each.
    kept = F.when(F.col(RANGES).isNull(), F.col(f"`{text_column}`")).otherwise(F.expr(f"""
        array_join(flatten(zip_with(concat(array(0), {RANGES}.to), concat({RANGES}.from, array(size({LINES}))),
          (a, b) -> slice({LINES}, a + 1, b - a))), '\n')"""))
    zero = F.lit(0).cast("long")
    added = {
        "n_lines": F.when(F.col(LINES).isNull(), zero).otherwise(F.size(LINES).cast("long")),
        "n_removed": F.coalesce(F.expr(f"aggregate({RANGES}, 0L, (a, r) -> a + (r.to - r.from))"), zero),
        "removed": F.coalesce(F.expr(f"array_join(transform({RANGES}, r -> concat(r.from, '-', r.to)), ',')"), F.lit("")),
    }
    columns = [kept.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns if c not in added]
    return rows.select(*columns, *[c.alias(n) for n, c in added.items()])


def without_repeats(
    docs: DataFrame, min_words: int = 10, id_column: str = "doc_id", text_column: str = "text", min_copies: int = 8,
) -> DataFrame:
    """The rows of `docs` with repeated runs of lines cut out; a text of which nothing is left is dropped with its row."""
    rows = dedup_lines(docs, min_words, id_column, text_column, min_copies)
    rows = rows.where((F.col("n_removed") == 0) | (F.trim(F.translate(F.col(f"`{text_column}`"), "\n", " ")) != ""))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle(min_words: int = 10, min_copies: int = 8) -> str:
    """The digest of `dedup_lines` in SQL, for unique `doc_id` and `text` of `documents`: runs are compared as whole strings.
    Words are what spaces separate, so it holds for tables without other white space and without long text that has none."""
    return f"""WITH r AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
    len(string_split(text, chr(10))) AS n_lines
  FROM documents WHERE text IS NOT NULL),
l AS (
  SELECT doc_id, line, pos, row_number() OVER o AS i, coalesce(lead(pos) OVER o, n_lines) AS next_pos,
    1 + length(trim(line, ' ')) - length(replace(trim(line, ' '), ' ', '')) AS words
  FROM r WHERE trim(line, ' ') <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
c AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS until, sum(words) OVER (PARTITION BY doc_id) AS total,
    sum(words) OVER (PARTITION BY doc_id ORDER BY i) - words AS since
  FROM l),
m AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id ORDER BY since RANGE BETWEEN CURRENT ROW AND {min_words - 1} FOLLOWING) AS ahead,
    count(*) OVER (PARTITION BY doc_id ORDER BY until RANGE BETWEEN {min_words - 1} PRECEDING AND CURRENT ROW) AS back
  FROM c),
w AS (
  SELECT doc_id, i AS s, ahead AS n FROM m WHERE total - since >= {min_words}
  UNION SELECT doc_id, i - back + 1, back FROM m WHERE until >= {min_words}),
t AS (
  SELECT w.doc_id, s, n, string_agg(line, chr(10) ORDER BY i) AS run
  FROM w JOIN l ON w.doc_id = l.doc_id AND l.i BETWEEN s AND s + n - 1 GROUP BY ALL),
x AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS copy FROM t),
q AS (
  SELECT doc_id, i, pos, next_pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS copy,
    count(*) OVER (PARTITION BY line) AS copies FROM l),
g AS (
  SELECT DISTINCT l.doc_id, l.i, l.pos, l.next_pos FROM x JOIN l ON x.doc_id = l.doc_id AND l.i BETWEEN s AND s + n - 1
  WHERE copy > 1
  UNION SELECT doc_id, i, pos, next_pos FROM q WHERE copy > 1 AND copies >= {min_copies}),
e AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM g),
f AS (SELECT doc_id, min(pos) AS a, max(next_pos) AS b FROM e GROUP BY doc_id, island),
k AS (
  SELECT r.doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM r
  WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = r.doc_id AND r.pos >= g.pos AND r.pos < g.next_pos) GROUP BY r.doc_id),
z AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, string_agg(a || '-' || b, ',' ORDER BY a) AS removed FROM f GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN z USING (doc_id) LEFT JOIN k USING (doc_id)"""
