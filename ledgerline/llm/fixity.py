"""Merkle fixity audit of archive replicas.

Records of an archive lie one after the other in files. A file's records, in order, make a hash
tree: a leaf covers 2**LEAF_BITS neighbouring record numbers and hashes the digests and lengths
of its records; a node hashes its up to 2**FANOUT_BITS children; and so on over the files up to one root. Every
node keeps the offset range that it covers. Two replicas with equal roots are equal. If roots
differ, the audit goes down one level at a time and joins only the children of nodes that
differ, until it arrives at the records that were altered, are missing or were added.

A node costs its children's digests and no text, and a damaged record costs one path down.

Defined results: ids are keys, and a record is placed by its id; one without an id is placed by
its digest, before the others of its file; repeated ids lie in the order of digests; offsets are within a file, in bytes; nulls are written as empty; an empty table
has no root, and against it all records are missing or added. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import materialize

LEAF_BITS = 3
FANOUT_BITS = 4
FILE_BITS = LEAF_BITS + 2 * FANOUT_BITS
NO_ID_RANGE = 1 << 20


def as_record(url: Column, body: Column) -> Column:
    """A page as a WARC resource record."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame) -> DataFrame:
    """(file, leaf, id, digest, start, end): every record at its place in its file."""
    record = as_record(F.col("url"), F.col("html"))
    sized = pages.select(F.col("page_id").cast("long").alias("id"), F.sha2(record, 256).alias("digest"), F.octet_length(record).alias("length"))
    number = F.coalesce(F.col("id"), F.pmod(F.xxhash64("digest"), F.lit(NO_ID_RANGE)))
    placed = sized.withColumn("leaf", F.shiftright(number, LEAF_BITS)).withColumn("file", F.shiftright(number, FILE_BITS))
    order = Window.partitionBy("file").orderBy(F.col("id").asc_nulls_first(), "digest").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("end", F.sum("length").over(order)).select(
        "file", "leaf", "id", "digest", (F.col("end") - F.col("length")).alias("start"), "end"
    )


def _joined(*order: str) -> Column:
    """The hash over digests in order."""
    listed = F.sort_array(F.collect_list(F.struct(*order)))
    return F.sha2(F.array_join(F.transform(listed, lambda x: x["digest"]), ""), 256)


def tree(rows: DataFrame) -> list[DataFrame]:
    """The levels of the tree from the leaves up, as (node, parent, digest, start, end) frames.

    Within a file offsets are its own; above files only digests matter. The number of levels is
    the logarithm of the range of ids, taken from two numbers.
    """
    leaf = rows.select(
        "leaf", "start", "end", "id", F.sha2(F.concat_ws("|", F.col("id"), "digest", F.col("end") - F.col("start")), 256).alias("digest")
    )
    level = leaf.groupBy(F.col("leaf").alias("node")).agg(
        _joined("start", "digest").alias("digest"), F.min("start").alias("start"), F.max("end").alias("end")
    )
    levels = []
    low, high = rows.agg(F.min("leaf"), F.max("leaf")).first()
    while True:
        stored = materialize(level.withColumn("parent", F.shiftright("node", FANOUT_BITS)), "tree")
        levels.append(stored)
        # Negative ids, if there are any, end in a second root.
        if low is None or low == high or (low, high) == (-1, 0):
            break
        low, high = low >> FANOUT_BITS, high >> FANOUT_BITS
        level = stored.groupBy(F.col("parent").alias("node")).agg(
            _joined("node", "digest").alias("digest"), F.min("start").alias("start"), F.max("end").alias("end")
        )
    return levels


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(id, finding, start, end, replica_start, replica_end): records of two replicas that differ.

    The finding is altered, missing (only in the first) or added (only in the second).
    """
    one, two = materialize(records(first), "records"), materialize(records(second), "records")
    trees = [tree(one), tree(two)]
    height = max(map(len, trees))
    differing = None
    for depth in range(height - 1, -1, -1):
        left, right = (t[depth] if depth < len(t) else t[-1].limit(0) for t in trees)
        if differing is not None:
            parents = differing.select(F.col("node").alias("parent"))
            left, right = left.join(parents, "parent", "left_semi"), right.join(parents, "parent", "left_semi")
        both = left.select("node", "digest").join(right.select("node", F.col("digest").alias("other")), "node", "full")
        differing = materialize(both.where("NOT (digest <=> other)").select("node"), "differing")
        if differing.isEmpty():
            break
    leaves = differing.select(F.col("node").alias("leaf"))
    return _records_that_differ(one.join(leaves, "leaf", "left_semi"), two.join(leaves, "leaf", "left_semi"))


def _records_that_differ(one: DataFrame, two: DataFrame) -> DataFrame:
    """Records with the same id are matched by digest, then in order."""
    same = Window.partitionBy("id", "digest").orderBy("start")
    one, two = (x.withColumn("copy", F.row_number().over(same)) for x in (one, two))
    matched = ["id", "digest", "copy"]

    def left_over(mine: DataFrame, other: DataFrame) -> DataFrame:
        other = other.select(*[F.col(c).alias(f"o_{c}") for c in matched])
        on = [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in matched]
        rest = mine.join(other, on, "left_anti")
        return rest.withColumn("turn", F.row_number().over(Window.partitionBy("id").orderBy("start")))

    gone = left_over(one, two).select("id", "turn", "start", "end")
    new = left_over(two, one).select(
        F.col("id").alias("new_id"), F.col("turn").alias("new_turn"), F.col("start").alias("replica_start"), F.col("end").alias("replica_end")
    )
    met = gone.join(new, F.col("id").eqNullSafe(F.col("new_id")) & (F.col("turn") == F.col("new_turn")), "full")
    finding = F.when(F.col("turn").isNull(), "added").when(F.col("new_turn").isNull(), "missing").otherwise("altered")
    return met.select(F.coalesce("id", "new_id").alias("page_id"), finding.alias("finding"), "start", "end", "replica_start", "replica_end")


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` with damage at ids that follow from the id alone: every 97th text
    has a changed character, every 89th ends early, every 83rd record is lost."""
    page, body = F.col("page_id"), F.coalesce(F.col("html"), F.lit(""))
    changed = F.when(page % 97 == 0, F.concat(F.lit("#"), F.substr(body, F.lit(2)))).when(
        page % 89 == 0, F.substr(body, F.lit(1), F.floor(F.length(body) / 2).cast("int"))
    ).otherwise(body)
    return pages.where("page_id IS NULL OR page_id % 83 <> 5").select("page_id", "url", changed.alias("html"))
