"""Name comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names match up to this many edits; the distance to a NULL name.
MAX_EDITS = 2
NULL_DISTANCE = 9999

def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First and last name with one space between; NULL if either is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def edit_distance(a: Column | str, b: Column | str) -> Column:
    """Edit distance of two strings; 9999 if either is NULL."""
    return F.coalesce(F.levenshtein(a, b), F.lit(NULL_DISTANCE))


def near(a: Column, b: Column) -> Column:
    """True if the strings differ by at most two edits.

    The bounded form stops early and answers -1 beyond the bound, hence the test for >= 0.
    """
    return F.levenshtein(a, b, MAX_EDITS) >= 0


PIECES = MAX_EDITS + 1


def _piece(length: Column, i: int, pieces: int) -> tuple[Column, Column]:
    """Start (from 0) and length of the i-th of ``pieces`` equal parts of a name."""
    start = F.floor(F.lit(i) * length / pieces).cast("int")
    return start, (F.floor(F.lit(i + 1) * length / pieces).cast("int") - start)


def own_pieces(name: Column, pieces: int = PIECES) -> Column:
    """The name cut into pieces, as ``(n, i, piece)`` with its length and the piece's number."""
    n = F.length(name)
    parts = []
    for i in range(pieces):
        start, size = _piece(n, i, pieces)
        parts.append(F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(name, start + 1, size).alias("piece")))
    return F.array(*parts)


def possible_pieces(name: Column, pieces: int = PIECES) -> Column:
    """What the pieces of a near name that is not longer can be, in the form of ``own_pieces``.

    Two edits leave all but two of the pieces as they are, moved by two places at most: 15 rows for
    a piece, however long the name is.
    """
    rows = []
    for shorter in range(MAX_EDITS + 1):
        n = F.length(name) - shorter
        for i in range(pieces):
            start, size = _piece(n, i, pieces)
            for moved in range(-MAX_EDITS, MAX_EDITS + 1):
                at = start + moved
                fits = (n >= 0) & (at >= 0) & (at + size <= F.length(name))
                row = F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(name, at + 1, size).alias("piece"))
                rows.append(F.when(fits, row))
    return F.array_distinct(F.array_compact(F.array(*rows)))


def with_deletions(df: DataFrame, name: str, every: bool) -> DataFrame:
    """Repeat each row once for each way to drop two letters of its name, with the hash of the rest as ``rest``;
    with ``every`` also for none and for one.

    Two names at most two edits apart have a rest in common that is the longer one less two letters (or all,
    if it has fewer), and the shorter one less two, one or none. Of equal neighbouring letters the first ones are
    dropped, as the others leave the same.
    """
    c, i, j = F.col(name), F.col("_i"), F.col("_j")
    n = F.length(c)

    def letter(at: Column) -> Column:
        return F.substring(c, at, F.lit(1))

    least = F.lit(0) if every else F.least(n, F.lit(1))
    own = (i < 2) | (letter(i) != letter(i - 1))
    # _i = 0 drops nothing, _j = _i one letter; of one letter only one can be dropped.
    to = F.when(i == 0, F.array(F.lit(0)))
    if every:
        to = to.otherwise(F.sequence(i, n))
    else:
        to = to.when(n < 2, F.array(i)).when(i < n, F.sequence(i + 1, n)).otherwise(F.array().cast("array<int>"))
    second = (j <= i + 1) | (letter(j) != letter(j - 1))
    rest = F.when(i == 0, c).otherwise(F.concat(
        F.substring(c, F.lit(1), i - 1),
        F.when(j > i, F.substring(c, i + 1, j - i - 1)).otherwise(F.lit("")),
        F.substring(c, j + 1, n),
    ))
    return (
        df.withColumn("_i", F.explode(F.sequence(least, n)))
        .where(own)
        .withColumn("_j", F.explode(to))
        .where(second)
        .select(*df.columns, F.xxhash64(rest).alias("rest"))
    )
