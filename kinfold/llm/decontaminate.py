"""Short test items found inside long documents. DataFrame functions only.

Texts are taken as sets of shingles of ``SHINGLE`` words, A-Z in lower case. An item is found in a document
that holds at least ``SHARE`` of the item's shingles. Documents may be a thousand times as long as an item,
so similarity of the sets says little; what is searched for is containment:

* Items are partitioned by size, each class up to twice the size of the one before.
* An item's sketch holds its shingles with the smallest hashes. Of n shingles a document with the share
  wanted lacks at most ``n - ceil(SHARE n)``, so one more than that many for the largest size of the
  class makes sure that such a document holds one of them: no match is lost.
* Documents that hold a hash of a sketch are candidates, and the shingles themselves are counted.

Only the sketches meet the shingles of all documents. Spark broadcasts them where their stored size allows it, and
shuffles by hash otherwise; nothing is broadcast by order.

Defined results: a NULL text, and one of fewer than ``SHINGLE`` words, has no shingle, finds
nothing and is never found; documents or items with the same id give one row for each pair of ids, the one with
the greatest share; a NULL id is an id of its own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import let
from kinfold.sources.scratch import cut_lineage

SHINGLE = 5
SHARE = 0.8
_SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _per_shingle(text: Column, n: int, of: str) -> Column:
    """``of`` applied to the words of each shingle: "hash" or "join"."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    words = F.filter(F.split(lower, _SPACE, -1), lambda w: w != "")
    make = F.xxhash64 if of == "hash" else (lambda s: F.array_join(s, " "))

    def each(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - (n - 1))
        return F.when(F.size(w) >= n, F.transform(places, lambda i: make(F.slice(w, i, n))))

    return let(words, each)


def _missing(n: Column, share: float) -> Column:
    return n - F.ceil(F.lit(share) * n)


def sketches(items: DataFrame, item_id: str, n: int = SHINGLE, share: float = SHARE) -> DataFrame:
    """``(item, h)``: of each item the smallest hashes, as many as its size class needs."""
    hashed = items.select(
        F.col(item_id).alias("item"), F.array_sort(F.array_distinct(_per_shingle(F.col("text"), n, "hash"))).alias("hashes")
    ).where(F.size("hashes") > 0)
    largest = F.pow(F.lit(2), F.floor(F.log2(F.size("hashes"))) + 1) - 1
    needed = (_missing(largest, share) + 1).cast("int")
    return hashed.select("item", F.explode(F.slice("hashes", F.lit(1), needed)).alias("h")).distinct()


def candidates(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, n: int, share: float) -> DataFrame:
    """Distinct ``(doc, item)`` where the document holds a hash of the item's sketch."""
    probes = cut_lineage(sketches(items, item_id, n, share), "sketches")
    shingles = docs.select(
        F.col(doc_id).alias("doc"), F.explode(_per_shingle(F.col("text"), n, "hash")).alias("h")
    )
    return shingles.join(probes, "h").select("doc", "item").distinct()


def contained(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
    n: int = SHINGLE, share: float = SHARE,
) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared, containment)`` of every item found in a document."""
    met = cut_lineage(candidates(docs, items, doc_id, item_id, n, share), "candidates")
    texts = docs.select(F.col(doc_id).alias("_doc"), F.col("text").alias("_text"))
    sets = items.select(
        F.col(item_id).alias("_item"), F.array_distinct(_per_shingle(F.col("text"), n, "join")).alias("_wanted")
    )
    pairs = (
        texts.join(met, F.col("_doc").eqNullSafe(F.col("doc")))
        .join(sets, F.col("_item").eqNullSafe(F.col("item")))
    )
    shared = F.size(F.array_intersect("_wanted", F.coalesce(_per_shingle(F.col("_text"), n, "join"), F.array().cast("array<string>"))))
    counted = pairs.select(
        F.col("doc").alias(doc_id), F.col("item").alias(item_id),
        F.size("_wanted").cast("long").alias("n_item"), shared.cast("long").alias("n_shared"),
    ).withColumn("containment", F.col("n_shared") / F.col("n_item"))
    found = counted.where(F.col("n_shared") >= F.ceil(F.lit(share) * F.col("n_item")))
    best = found.groupBy(doc_id, item_id).agg(
        F.max(F.struct("containment", "n_shared", "n_item")).alias("_best")
    )
    return best.select(
        doc_id, item_id, "_best.n_item", "_best.n_shared", "_best.containment"
    )


def without_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` whose id has no row in which an item is found, all columns unchanged."""
    found = contained(docs, items, doc_id, item_id).select(F.col(doc_id).alias("_found")).distinct()
    found = cut_lineage(found, "found")
    return docs.join(found, docs[doc_id].eqNullSafe(found["_found"]), "left_anti")


def clean_rows(docs: DataFrame, items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns unchanged. Rows are told apart by a number of
    their own, so a row goes for its own text only, whatever its id and whoever shares it."""
    numbered = cut_lineage(
        docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
        .withColumn("_n", F.monotonically_increasing_id()),
        "numbered",
    )
    rows = numbered.select("_n", F.col("_row.text").alias("text"))
    found = cut_lineage(contained(rows, items, "_n", item_id).select("_n").distinct(), "found")
    return numbered.join(found, "_n", "left_anti").select("_row.*")
