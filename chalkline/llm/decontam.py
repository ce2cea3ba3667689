"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame operations.

A test item is short and a document may be long, so similarity is the containment of the item's
shingles in the document. Items fall in size classes by powers of two of their number of distinct
shingles, and each class has the threshold converted to its sizes: a match holds at least a number of shingles, and
may miss at most another. An item's MinHash sketch is its k least shingle hashes, with k one more than its
class may miss: of k sketch members at least one is in any document that holds the threshold's share of
the item, so the search loses nothing at any document length. A document's shingle hashes are first held against the
buckets that any sketch has a member in, inside its row; those that pass meet the sketches in a join, where a class leaves out
documents with fewer shingles than a match of it must hold. The documents found are verified by the exact containment of
shingle texts.

A document's own signature (least hashes, or bands) would not do: of 20,000 shingles, 36 of an item are seldom among the least.
Sketches and found ids are written tables; Spark broadcasts them below its own limit of bytes and deals them beyond.

Items of fewer than ``shingle`` words are one shingle of all their words, looked up among the
documents' shingles of that length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import absent, remove, same, session, written

#: Words in a shingle, and the share of an item's shingles that a document must hold.
SHINGLE, THRESHOLD = 5, 0.8
#: Buckets of sketch hashes, a power of two. They are one value in the plan, so the driver holds some copies of as many bytes.
MARKS = 1 << 17


def words(text: Column) -> Column:
    """Runs of letters and digits of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def _positions(ws: Column, k: int) -> Column:
    return F.when(F.size(ws) >= k, F.sequence(F.lit(0), F.size(ws) - k)).otherwise(F.array().cast("array<int>"))


def _texts(ws: Column, k: int) -> Column:
    return F.transform(_positions(ws, k), lambda i: F.array_join(F.slice(ws, i + 1, k), " "))


def _hashes(hs: Column, k: int) -> Column:
    return F.transform(_positions(hs, k), lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(k)]))


def item_shingles(items: DataFrame, item_col: str, text_col: str, shingle: int) -> DataFrame:
    """(item_id, k, ws, n): distinct rows of items with words; k is the item's shingle length."""
    return (items.select(items[item_col].alias("item_id"), words(items[text_col]).alias("ws")).where(F.size("ws") > 0).distinct()
            .withColumn("k", F.least(F.size("ws"), F.lit(shingle))))


def contaminated(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_found, containment) at ``threshold`` or above.

    Counts are of distinct shingles. Rows that share an id are one document (or item), which holds
    the shingles of each of its rows; a null id is an id like others. Null and empty texts and
    items without a letter or digit match nothing; a very long text is searched whole, its shingles held by one task;
    either table may be empty; other columns are not read.
    """
    spark = session(docs)
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    listed = item_shingles(items, item_col, item_text_col, shingle)
    lengths = sorted(r.k for r in listed.select("k").distinct().collect())  # at most ``shingle`` rows
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, item_id {dict(listed.dtypes)['item_id']}, n_shingles long, n_found long, containment double"
    if not lengths:
        return spark.createDataFrame([], schema)

    parts = [listed.where(F.col("k") == k).select("item_id", F.lit(k).alias("k"), F.explode(_texts(F.col("ws"), k)).alias("shingle")) for k in lengths]
    shingles = parts[0]
    for part in parts[1:]:
        shingles = shingles.unionByName(part)
    own = written(shingles.distinct(), "shingles")

    # the sketch: k least hashes, k by the item's size class
    hashed = own.withColumn("h", _shingle_hash(lengths))
    sized = own.groupBy(F.col("item_id").alias("i_id")).agg(F.count(F.lit(1)).alias("n_shingles"))  # a null id is an id
    sized = sized.withColumn("class", F.ceil(F.log2(F.col("n_shingles"))).cast("int"))
    missing = F.floor(F.pow(F.lit(2.0), F.col("class")) * F.lit(1 - threshold) + F.lit(1e-9))
    sized = written(sized.withColumn("sketch", F.least(F.col("n_shingles"), (missing + 1).cast("long"))), "sizes")
    sketches = (hashed.groupBy("item_id").agg(F.array_sort(F.collect_set("h")).alias("hs")).join(sized, same(F.col("item_id"), F.col("i_id")))
                .select("item_id", "class", "n_shingles", F.explode(F.slice("hs", F.lit(1), F.col("sketch").cast("int"))).alias("h")))
    sketches = written(sketches, "sketches")
    # shingles that a match of the class holds at least; a row for each power of two
    least = F.ceil(F.min("n_shingles") * F.lit(threshold) - F.lit(1e-9)).alias("least")
    classes = sketches.groupBy(F.col("class").alias("of")).agg(least)
    wanted = sketches.join(F.broadcast(classes), F.col("class") == F.col("of")).select("item_id", "h", "least")

    looked = texts.select("doc_id", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hs"))
    looked = looked.select("doc_id", F.concat(*[_hashes(F.col("hs"), k) for k in lengths]).alias("all"))
    met = looked.select("doc_id", F.size("all").alias("n_all"), F.explode(F.filter("all", _member(sketches))).alias("h"))
    found = met.join(wanted, "h").where(F.col("n_all") >= F.col("least"))
    pairs = written(found.select("doc_id", "item_id").distinct(), "candidates")
    remove(spark, sketches)

    # exact containment of the candidates
    suspects = written(pairs.select(F.col("doc_id").alias("s_id")).distinct(), "suspects")
    held = texts.join(suspects, same(texts["doc_id"], F.col("s_id")), "left_semi")
    held = held.select("doc_id", words(F.col("text")).alias("ws"))
    held = held.select("doc_id", F.explode(F.array_distinct(F.concat(*[_texts(F.col("ws"), k) for k in lengths]))).alias("shingle"))
    hits = held.join(own, "shingle").select("doc_id", "item_id", "shingle").distinct().groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_found"))
    share = F.col("n_found").cast("double") / F.col("n_shingles").cast("double")
    scored = hits.join(sized, same(F.col("item_id"), F.col("i_id"))).select("doc_id", "item_id", "n_shingles", "n_found", share.alias("containment"))
    named = pairs.select(F.col("doc_id").alias("p_doc"), F.col("item_id").alias("p_item"))
    return (scored.where(F.col("containment") >= threshold - 1e-12)
            .join(named, same(F.col("doc_id"), F.col("p_doc")) & same(F.col("item_id"), F.col("p_item")), "left_semi"))


def _member(sketches: DataFrame) -> Callable[[Column], Column]:
    """Whether a hash may be in a sketch: a byte of ``MARKS`` for its last bits, the same at every number of items.

    Its sketches' buckets are gathered as one value of that many bytes, so a document's other shingles never leave its row.
    """
    bucket = F.col("h").bitwiseAND(F.lit(MARKS - 1))
    groups = sketches.select(F.shiftright(bucket, 6).alias("id"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit")).groupBy("id").agg(F.bit_or("bit").alias("bits"))
    every = session(sketches).range(MARKS // 64).join(groups, "id", "left")
    told = every.select("id", F.reverse(F.lpad(F.bin(F.coalesce("bits", F.lit(0).cast("long"))), 64, "0")).alias("part"))
    marks = told.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "part"))), lambda x: x["part"]), "").alias("marks")).first().marks
    return lambda h: F.substring(F.lit(marks.encode()), h.bitwiseAND(F.lit(MARKS - 1)).cast("int") + 1, 1) == F.lit(b"1")


def _shingle_hash(lengths: list[int]) -> Column:
    """As ``_hashes`` has it, of a shingle's words."""
    parts = F.split("shingle", " ")
    out = F.lit(None).cast("long")
    for k in lengths:
        out = F.when(F.col("k") == k, F.xxhash64(*[F.xxhash64(F.get(parts, F.lit(j))) for j in range(k)])).otherwise(out)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns stay as they are."""
    (name,) = absent(docs, "bad")
    bad = written(contaminated(docs, items, id_col=id_col, **options).select(F.col("doc_id").alias(name)).distinct(), "bad")
    return docs.join(bad, same(docs[id_col], bad[name]), "left_anti")


#: DuckDB SQL for ``contaminated`` on the tables documents and benchmark.
SQL = r"""
WITH i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM benchmark),
iw AS (SELECT item_id, ws, least(len(ws), 5) AS k FROM i WHERE len(ws) > 0),
isg AS (SELECT DISTINCT item_id, k, array_to_string(ws[p : p + k - 1], ' ') AS s FROM (SELECT item_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS p FROM iw)),
n AS (SELECT item_id, count(DISTINCT s) AS n_shingles FROM isg GROUP BY item_id),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
dp AS (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS p FROM dw, ks WHERE len(ws) >= k),
ds AS (SELECT DISTINCT doc_id, array_to_string(ws[p : p + k - 1], ' ') AS s FROM dp),
h AS (SELECT doc_id, item_id, count(DISTINCT isg.s) AS n_found FROM ds JOIN isg ON ds.s = isg.s GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_found, CAST(n_found AS DOUBLE) / CAST(n_shingles AS DOUBLE) AS containment
FROM h JOIN n USING (item_id) WHERE CAST(n_found AS DOUBLE) / CAST(n_shingles AS DOUBLE) >= 0.8 - 1e-12
"""
