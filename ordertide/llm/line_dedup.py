"""Removal of lines that many sites share, by the spread of distinct sites per line.

A line counts under the hash of its text without blanks at either end. HyperLogLog sketches
of the sites are merged per line hash; where an estimate lies so near the threshold that its
error could decide, the sites are counted exactly. Such a line stays in the document with the
smallest id that holds it and goes from all others.

Defined cases: a null source is a site of its own; null and empty texts stay as they are;
a line of w < ``MIN_WORDS`` words needs ``MIN_WORDS`` + 1 - w times as many sites, since short ones may
be prose (without ``short`` they all stay); a line without a word is never removed; repeated rows are treated alike;
equal ids with different texts are told apart by their texts; a document that loses all lines
stays with an empty text; extra columns, whatever their names, pass through.
"""

from pyspark.sql import functions as F

from ordertide.llm.shared import saved

#: A line on at least so many sites is boilerplate.
MIN_SITES = 5
#: A line of so many words needs no more sites than that: 4 words need 10 sites, 3 need 15, 2 need 20, 1 needs 25.
MIN_WORDS = 5
#: Log2 of the sketch's registers; the relative standard error is 1.04 / sqrt(2**SKETCH).
SKETCH = 8

_BLANKS = " \t\x0b\f\r"
_GAP = r"[ \t\x0b\f\r]+"


def _row_key(docs):
    return F.xxhash64(docs["doc_id"], docs["text"])


def lines_of(docs, min_sites=MIN_SITES, min_words=MIN_WORDS, short=True):
    """doc_id, row key, site, position, hash and needed sites of each line that may be boilerplate."""
    rows = docs.where(docs["text"].isNotNull()).select(
        docs["doc_id"].alias("id"),
        _row_key(docs).alias("row"),
        F.xxhash64(docs["source"]).alias("site"),
        F.posexplode(F.split(docs["text"], "\n", -1)).alias("pos", "line"),
    )
    line = F.trim(F.col("line"), F.lit(_BLANKS))
    rows = rows.select("id", "row", "site", "pos", line.alias("line")).where("line <> ''")
    words = F.size(F.split("line", _GAP, min_words))  # at most min_words
    if not short:
        rows = rows.where(words >= min_words)
    need = (min_sites * (min_words + 1 - words)).alias("need")
    return rows.select("id", "row", "site", "pos", F.xxhash64("line").alias("key"), need)


def widespread_lines(docs, min_sites=MIN_SITES, sketch=SKETCH, min_words=MIN_WORDS, short=True):
    """key, sites (estimated or exact) and first_id of every line on as many sites as it needs."""
    lines = lines_of(docs, min_sites, min_words, short)
    margin = 1 + 4 * 1.04 / 2 ** (sketch / 2) * F.col("need")
    merged = lines.groupBy("key", "need")
    merged = merged.agg(F.hll_sketch_agg("site", F.lit(sketch)).alias("s"), F.min("id").alias("first_id"))
    spread = saved(
        merged.select("key", "need", "first_id", F.hll_sketch_estimate("s").alias("sites")).where(
            F.col("sites") >= F.col("need") - margin
        ),
        "line-spread",
    )
    sure = spread.where(F.col("sites") > F.col("need") + margin)
    near = spread.where(F.col("sites") <= F.col("need") + margin)
    pairs = lines.join(near.select("key"), "key", "left_semi").select("key", "site").distinct()
    exact = pairs.groupBy("key").agg(F.count("*").alias("n"))
    decided = near.join(exact, "key").where("n >= need").select("key", F.col("n").alias("sites"), "first_id")
    return saved(sure.select("key", "sites", "first_id").unionByName(decided), "wide-lines")


def removed_lines(docs, wide, min_words=MIN_WORDS, short=True):
    """Row key, id and the sorted positions of the lines that go, one row for each affected document."""
    hits = lines_of(docs, min_words=min_words, short=short).join(wide.select("key", "first_id"), "key")
    hits = hits.where(~F.col("id").eqNullSafe(F.col("first_id")))
    return hits.groupBy("row", "id").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def _without(lines, gone):
    """The lines between the sorted positions in ``gone``, joined again; linear in both lengths."""
    ends = F.concat(gone, F.array(F.size(lines)))

    def between(end, i):
        start = F.when(i == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(i, F.lit(1))) + 1)
        return F.slice(lines, start + 1, end - start)

    return F.array_join(F.flatten(F.transform(ends, between)), "\n")


def dedup_lines(docs, min_sites=MIN_SITES, sketch=SKETCH, min_words=MIN_WORDS, count=None, short=True):
    """The documents without boilerplate lines; ``count`` names a column for the number of lines removed,
    which takes the place of one of that name."""
    gone = removed_lines(docs, widespread_lines(docs, min_sites, sketch, min_words, short), min_words, short)
    gone = gone.select(F.col("row").alias("_row"), F.col("id").alias("_id"), F.col("gone").alias("_gone"))
    joined = docs.join(gone, (_row_key(docs) == gone["_row"]) & docs["doc_id"].eqNullSafe(gone["_id"]), "left")
    text = F.when(gone["_gone"].isNull(), docs["text"]).otherwise(
        _without(F.split(docs["text"], "\n", -1), gone["_gone"])
    )
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns if c.lower() != (count or "").lower()]
    if count:
        columns.append(F.coalesce(F.size(gone["_gone"]), F.lit(0)).cast("long").alias(count))
    return joined.select(*columns)


def line_dedup_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = dedup_lines(docs, count="n_removed")
    return out.select("doc_id", "n_removed", F.md5(F.encode("text", "UTF-8")).alias("kept_md5"))


LINE_DEDUP_SQL = f"""
WITH split AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
keyed AS (
  SELECT doc_id, source, pos, line,
         nullif(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '') AS key
  FROM split),
wide AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE key IS NOT NULL
  GROUP BY key HAVING count(DISTINCT coalesce(source, chr(1))) >= {MIN_SITES}
    * ({MIN_WORDS} + 1 - least({MIN_WORDS}, len(string_split_regex(key, '[ \\t\\x0b\\f\\r]+'))))),
judged AS (
  SELECT k.doc_id, k.pos, k.line, w.key IS NOT NULL AND w.first_id IS DISTINCT FROM k.doc_id AS gone
  FROM keyed k LEFT JOIN wide w USING (key))
SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_md5
FROM judged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, NULL FROM documents WHERE text IS NULL
"""
