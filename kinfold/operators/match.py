"""Links between records of the same person.

Two customers match if they share an email or a phone and their full names differ by at most two
edits. A shared email or phone is a *block*. Blocks differ in size by many orders of magnitude: a
personal email is shared by two or three records, a placeholder phone by a third of all. So names
are first reduced to the distinct ones per block, and near names then meet in equi-joins on parts that
few names of a block share, so that the names that meet are not many more than the names and the true
matches:

* in a block of at most ``FEW`` names all meet;
* in a larger block, names of up to ``SHORT`` letters meet under what is left without two letters, which only names
  within two letters of each other share, whatever else is common to the block;
* longer names are cut into five pieces, of which two edits leave three. So one name is put under its three
  rarest pieces, by their number in the block, and the other under all that these may be. A name
  whose third rarest piece is still that of many names is put under its deletions, too.

The edit distance is part of the joins, so only true matches leave them.

The distinct names are needed several times and are written to the shared folder first, so these
functions start jobs when they are called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import MAX_EDITS, full_name, near, own_pieces, possible_pieces, with_deletions
from kinfold.operators.closure import connected_components
from kinfold.operators.skew import HOT_ROWS, large, lookup_join, spread
from kinfold.sources.scratch import cut_lineage

_BLOCK = ["kind", "block"]
_NAME = [*_BLOCK, "number", "name", "fresh_id"]
#: Names of a block that are all compared; letters of a name that is put under its deletions (about n^2 / 2 rows).
FEW, SHORT = 16, 32
LONG_PIECES = 5
#: Rows under which names of large blocks meet at a time: some 16 bytes each on the disks.
PORTION_ROWS = 60_000_000


def _entries(customers: DataFrame, fresh: str | None = None) -> DataFrame:
    """One narrow row per customer and contact; a NULL contact or name matches nothing."""
    is_fresh = F.lit(True) if fresh is None else F.col(fresh)
    contacts = F.array(
        F.struct(F.lit("email").alias("kind"), F.col("email").alias("block")),
        F.struct(F.lit("phone").alias("kind"), F.col("phone").alias("block")),
    )
    return (
        customers.select("customer_id", full_name().alias("name"), is_fresh.alias("fresh"), F.explode(contacts).alias("c"))
        .select("customer_id", "name", "fresh", "c.kind", "c.block")
        .where("block is not null and name is not null")
    )


def _names(entries: DataFrame) -> DataFrame:
    """The distinct names of each block: the smallest customer, the smallest fresh one and the smallest other."""
    one = F.col("customer_id")
    return entries.groupBy(*_BLOCK, "name").agg(
        F.min(one).alias("first_id"), F.count("*").alias("n_ids"),
        F.min(F.when(F.col("fresh"), one)).alias("fresh_id"), F.min(F.when(~F.col("fresh"), one)).alias("old_id"),
    )


def _meet(a: DataFrame, b: DataFrame, keys: list[str], some: bool) -> DataFrame:
    """Numbers ``(a, b)`` of different names of a block that share a key, ``a`` with the shorter or, of equally long ones, the one
    with the lesser number.

    Blocks and keys are hashed together and names stay where they are, so rows are narrow; the few pairs that only hashes bring
    together are compared like the others. With ``some``, one of the two has to have a fresh customer; the names of the others only
    meet these.
    """

    def side(names: DataFrame, s: str) -> DataFrame:
        return names.select(
            F.xxhash64(*_BLOCK, *keys).alias("key"), F.col("number").alias(s), F.length("name").alias(f"n_{s}"), F.col("fresh_id").isNotNull().alias(f"f_{s}")
        )

    one, other = side(a, "a"), side(b, "b")
    shorter, longer = F.col("n_a"), F.col("n_b")
    once = (longer <= shorter + MAX_EDITS) & ((shorter < longer) | ((shorter == longer) & (F.col("a") < F.col("b"))))
    same = one["key"] == other["key"]
    if not some:
        return one.join(large(other), same & once).select("a", "b")
    fresh = one.where("f_a").join(large(other), same & once).select("a", "b")
    return fresh.unionByName(one.where("not f_a").join(large(other.where("f_b")), same & once).select("a", "b"))


def _by_rare_pieces(long: DataFrame, min_rows: int) -> DataFrame:
    """Long names with their three rarest pieces, and whether these are ``rare`` enough to meet under."""
    keys = [*_BLOCK, "n", "i", "piece"]
    cut = long.select(*_NAME, F.explode(own_pieces(F.col("name"), LONG_PIECES)).alias("p"))
    pieces = cut.select(*_NAME, "p.*")
    counts = pieces.groupBy(*keys).agg(F.count("*").alias("n_names"))
    counted = lookup_join(pieces, counts, keys, "n_names", min_rows)
    by_count = F.array_sort(F.collect_list(F.struct("n_names", "n", "i", "piece")))
    left = LONG_PIECES - MAX_EDITS
    return (
        counted.groupBy(*_NAME).agg(F.slice(by_count, 1, left).alias("rarest"))
        .withColumn("rare", F.col("rarest")[left - 1]["n_names"] <= F.pow(F.length("name"), F.lit(2)) / 4)
    )


def _met(names: DataFrame, min_rows: int, some: bool = False) -> DataFrame:
    """Pairs of names that may be near, among them all that are: (kind, block, name_a, id_a, fresh_a, name_b, id_b, fresh_b).

    ``names`` has the distinct names of each block (``_names``). A block with one name, or without a fresh customer, has no
    pair and is left out first; the others get numbers. Which ways are needed is counted before they are planned.
    """
    sizes = names.groupBy(*_BLOCK).agg(F.count("*").alias("n_names"), F.count("fresh_id").alias("n_fresh"))
    sizes = sizes.where("n_names > 1 and n_fresh > 0").drop("n_fresh")
    rest = lookup_join(names.select(*_BLOCK, "name", "first_id", "fresh_id"), sizes, _BLOCK, "n_names", min_rows)
    rest = cut_lineage(rest.withColumn("number", F.monotonically_increasing_id()), "shared-names")
    small, crowded, length = F.col("n_names") <= FEW, F.col("n_names") > FEW, F.length("name")
    n = rest.agg(F.count_if(crowded).alias("large"), F.count_if(crowded & (length > SHORT)).alias("long")).first()
    ways = [_meet(rest.where(small), rest.where(small), [], some)]
    big = spread(rest.where(crowded), *_BLOCK, "name")
    if n.large:
        shorter = with_deletions(big.where(length <= SHORT), "name", every=True)
        longer = with_deletions(big.where(length <= SHORT + MAX_EDITS), "name", every=False)
        ways.append(_meet(shorter, longer, ["rest"], some))
    if n.long:
        long = big.where(length > SHORT)
        placed = cut_lineage(_by_rare_pieces(long, min_rows), "rare-pieces")
        keys = ["n", "i", "piece"]
        own = placed.where("rare").withColumn("p", F.explode("rarest"))
        possible = long.withColumn("p", F.explode(possible_pieces(F.col("name"), LONG_PIECES)))
        ways.append(_meet(*[d.select(*_NAME, *[f"p.{k}" for k in keys]) for d in (own, possible)], keys, some))
        common = placed.where("not rare").drop("rarest", "rare")
        if not common.isEmpty():
            lengths = common.select(*_BLOCK, F.explode(F.sequence(length, length + MAX_EDITS)).alias("_length")).distinct()
            about = long.withColumn("_length", length).join(large(lengths), [*_BLOCK, "_length"], "left_semi").drop("_length")
            ways.append(_meet(with_deletions(common, "name", True), with_deletions(about, "name", False), ["rest"], some))
    pairs = reduce(DataFrame.unionByName, ways).distinct()
    for s in "ab":
        named = rest.select(
            F.col("number").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("kind", "block", "name")],
            F.col("first_id").alias(f"id_{s}"), F.col("fresh_id").alias(f"fresh_{s}"),
        )
        pairs = pairs.join(large(named), s)
    met = pairs.where("kind_a = kind_b and block_a = block_b").withColumnsRenamed({"kind_a": "kind", "block_a": "block"})
    return met.select(*_BLOCK, "name_a", "id_a", "fresh_a", "name_b", "id_b", "fresh_b")


def _near_names(names: DataFrame, min_rows: int, some: bool = False) -> DataFrame:
    """Pairs of different near names of a block, each once, with the columns of ``_met``."""
    return _met(names, min_rows, some).where(near(F.col("name_a"), F.col("name_b")))


def _in_portions(names: DataFrame, min_rows: int, some: bool, use: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``use`` of the near names, stored for one portion of the blocks after the other.

    A name of a large block meets others under hundreds of rows, all of which lie on the disks while they are joined. Names of different
    blocks never meet, so with as many portions as there are times ``PORTION_ROWS`` of these rows, no more of them lie there
    at a time, or as many as the largest block has.
    """
    squares = F.pow(F.least(F.length("name"), F.lit(SHORT)), F.lit(2))
    sizes = names.groupBy(*_BLOCK).agg(F.count("*").alias("n"), F.count("fresh_id").alias("n_fresh"), F.sum(squares).alias("rows"))
    met = sizes.where((F.col("n") > FEW) & (F.col("n_fresh") > 0)).agg(F.sum("rows")).first()[0] or 0
    n = max(1, -int(-met // PORTION_ROWS))
    own = [names if n == 1 else names.where(F.pmod(F.xxhash64(*_BLOCK), F.lit(n)) == i) for i in range(n)]
    return reduce(DataFrame.unionByName, [cut_lineage(use(_near_names(part, min_rows, some)), "near-names") for part in own])


def block_sizes(customers: DataFrame, min_customers: int = 2) -> DataFrame:
    """``(kind, block, n_customers, n_names)`` of the emails and phones that at least so many customers share.

    A placeholder that everyone was given shows up here as a block with many names. Customers are counted by name before they
    meet in a block, so a large one is no burden. Empty contacts are blocks too; NULL ones, and customers without a
    name, belong to none.
    """
    return (
        _entries(customers).groupBy(*_BLOCK, "name").agg(F.count("*").alias("n"))
        .groupBy(*_BLOCK).agg(F.sum("n").alias("n_customers"), F.count("*").alias("n_names"))
        .where(F.col("n_customers") >= min_customers)
    )


def match_pairs(customers: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """All matching pairs ``(id_a, id_b)`` with ``id_a < id_b``, each once.

    The result itself is as large as the matches are many; the golden ids below do not need it.
    """
    entries = cut_lineage(_entries(customers).drop("fresh"), "entries")
    names = cut_lineage(_names(entries.withColumn("fresh", F.lit(True))), "names")
    near_names = _in_portions(names, min_rows, False, lambda pairs: pairs.select(*_BLOCK, "name_a", "name_b"))
    a = entries.withColumnsRenamed({"name": "name_a", "customer_id": "id_a"})
    b = entries.withColumnsRenamed({"name": "name_b", "customer_id": "id_b"})
    across = near_names.join(large(a), [*_BLOCK, "name_a"]).join(large(b), [*_BLOCK, "name_b"])
    same = a.withColumnRenamed("name_a", "name").join(large(b.withColumnRenamed("name_b", "name")), [*_BLOCK, "name"])
    both = across.select("id_a", "id_b").unionByName(same.select("id_a", "id_b")).where("id_a <> id_b")
    return both.select(
        F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")
    ).distinct()


def _nearest_ids(pairs: DataFrame) -> DataFrame:
    """For each name the smallest id and the smallest fresh one among its near names."""
    ends = F.array(*[
        F.struct(F.col(f"name_{a}").alias("name"), F.col(f"id_{b}").alias("near_id"), F.col(f"fresh_{b}").alias("fresh_id"))
        for a, b in ("ab", "ba")
    ])
    return (
        pairs.select(*_BLOCK, F.explode(ends).alias("e")).select(*_BLOCK, "e.*")
        .groupBy(*_BLOCK, "name").agg(F.min("near_id").alias("near_id"), F.min("fresh_id").alias("fresh_id"))
    )


def one_hop(customers: DataFrame, min_rows: int = HOT_ROWS, fresh: str | None = None) -> DataFrame:
    """``(customer_id, golden_customer_id)`` of every customer with a contact: the smallest id among
    the customer itself and its direct matches.

    ``fresh`` names a boolean column. Where it is true the result is the same; a customer where it is not gets the smallest
    of its fresh matches only, or NULL, and two such customers are never compared.
    """
    entries = _entries(customers, fresh)
    names = cut_lineage(_names(entries), "names")
    near_ids = _in_portions(names, min_rows, fresh is not None, _nearest_ids)
    nearest = (
        names.select(*_BLOCK, "name", F.col("first_id").alias("near_id"), "fresh_id", "n_ids")
        .unionByName(near_ids.withColumn("n_ids", F.lit(0)))
        .groupBy(*_BLOCK, "name")
        .agg(F.min("near_id").alias("near_id"), F.min("fresh_id").alias("near_fresh"), F.sum("n_ids").alias("n_ids"))
    )
    found = lookup_join(entries, nearest, [*_BLOCK, "name"], "n_ids", min_rows)
    return found.groupBy("customer_id").agg(
        F.min(F.when(F.col("fresh"), F.col("near_id")).otherwise(F.col("near_fresh"))).alias("golden_customer_id")
    )


def match_edges(customers: DataFrame, min_rows: int = HOT_ROWS, fresh: str | None = None) -> DataFrame:
    """A set of edges ``(u, v)`` that connects exactly what the matching pairs connect.

    Customers of one block and name form a star around the smallest id; two near names are one
    edge between their smallest ids, however many customers bear them. With ``fresh``, a boolean column, customers where it is false
    are taken to be connected already if they match each other, and are not compared.
    """
    entries = _entries(customers, fresh)
    names = cut_lineage(_names(entries), "names")
    centre = F.coalesce("old_id", "first_id").alias("v")
    several = names.where("n_ids > 1 and fresh_id is not null").select(*_BLOCK, "name", "n_ids", centre)
    copies = lookup_join(entries.where("fresh"), several, [*_BLOCK, "name"], "n_ids", min_rows).select(
        F.col("customer_id").alias("u"), "v"
    )
    edges = [F.col("id_a").alias("u"), F.col("id_b").alias("v")]
    across = _in_portions(names, min_rows, fresh is not None, lambda pairs: pairs.select(*edges))
    return copies.unionByName(across).where("u <> v")


def transitive(customers: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """``(customer_id, golden_customer_id)`` of every matched customer: the smallest id of all
    customers reachable through matches."""
    return connected_components(match_edges(customers, min_rows)).select(
        F.col("node").alias("customer_id"), F.col("component").alias("golden_customer_id")
    )


def assign_golden(
    customers: DataFrame, closure: str = "one_hop", min_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``golden_customer_id``; a customer without a match keeps its own id.

    ``closure="one_hop"`` takes the smallest id among direct matches, ``"transitive"`` among all
    customers reachable through matches. Only ids, contacts and names are shuffled by block; the
    full rows are joined once, by customer id. Groups of at least ``min_rows`` rows are salted.
    """
    if closure not in ("one_hop", "transitive"):
        raise ValueError("closure must be 'one_hop' or 'transitive'")
    find = one_hop if closure == "one_hop" else transitive
    golden = find(customers, min_rows)
    return customers.join(large(golden), "customer_id", "left").withColumn(
        "golden_customer_id", F.coalesce("golden_customer_id", "customer_id")
    )
