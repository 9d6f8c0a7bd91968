"""WARC fixity audit with Merkle trees over ordered offset ranges.

A record's leaf is the hash of its offset, length and bytes. Leaves are hashed
in order into ranges of ``RANGE_BYTES`` of their archive, ranges into ranges
``FANOUT`` times as wide, and so on to one root an archive. Two replicas are
compared root by root; only ranges under a node that differs are looked at on
the next level, and only the leaves of differing ranges are compared singly.

Each node has at most ``FANOUT`` children (a lowest range as many records as
fit in its bytes), whatever the size of an archive, so no archive meets in one
task. Records with one offset are summed into one leaf before a range is built
(commutative sums of their hashes), so repeated rows are safe too.

Defined results: null archive and null offset are keys of their own; null bytes
hash as their own mark; equal rows count (a copy more or less is a difference);
two empty replicas have no differences; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import col, stage

RANGE_BYTES = 1 << 16
FANOUT = 16


def warc_records(pages: DataFrame, per_archive: int = 1000) -> DataFrame:
    """(archive, page_id, length, record): a WARC response record for each page,
    ``per_archive`` pages by id in an archive."""
    body = F.encode(F.coalesce(col("html"), F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(col("url"), F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    record = F.concat(F.encode(head, "UTF-8"), body, F.lit("\r\n\r\n").cast("binary"))
    rows = pages.select(F.floor(col("page_id") / per_archive).cast("long").alias("archive"), col("page_id").alias("page_id"),
                        record.alias("record"))
    return rows.select("archive", "page_id", F.octet_length("record").cast("long").alias("length"), "record")


def placed(rows: DataFrame) -> DataFrame:
    """(archive, page_id, length, digest, ...) with the offset of each record, in
    order of id, url and content: the lengths before it in its archive. Rows are
    sorted here, so they hold digests and no records."""
    from pyspark.sql import Window

    before = Window.partitionBy("archive").orderBy(F.col("page_id").asc_nulls_first(), "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def _leaf() -> Column:
    return F.sha2(F.concat_ws("|", F.col("offset").cast("string"), F.col("length").cast("string"),
                              F.coalesce(F.col("digest"), F.lit("null"))), 256)


def digests(records: DataFrame) -> DataFrame:
    """(archive, offset, length, digest) of (archive, offset, length, record)."""
    return records.select(col("archive"), col("offset"), col("length"), F.sha2(col("record"), 256).alias("digest"))


def leaves(digested: DataFrame) -> DataFrame:
    """(archive, offset, n, hash): one row an offset."""
    h = _leaf()
    part = [F.sum(F.conv(F.substring(h, 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(5)]
    return digested.groupBy("archive", "offset").agg(
        F.count(F.lit(1)).alias("n"), F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *part), 256).alias("hash"))


def _range(level: int) -> Column:
    return F.floor(F.col("offset") / (RANGE_BYTES * FANOUT ** level)).cast("long")


def tree(leaf: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (replica, archive, node, hash), lowest ranges first, one root an
    archive last; each level is written."""
    order = F.array_sort(F.collect_list(F.struct(F.col("at").alias("at"), F.col("hash").alias("hash"))))
    node = F.sha2(F.concat_ws("|", F.transform(order, lambda x: F.concat_ws(":", x["at"].cast("string"), x["hash"]))), 256)
    out = []
    below = leaf.select("replica", "archive", _range(0).alias("node"), F.col("offset").alias("at"), "hash")
    for level in range(levels + 1):
        done = stage(below.groupBy("replica", "archive", "node").agg(node.alias("hash")), f"merkle-{level}")
        out.append(done)
        below = done.select("replica", "archive", F.floor(F.col("node") / FANOUT).cast("long").alias("node"),
                            F.col("node").alias("at"), "hash")
    return out


def _differing(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hash is not the same in both replicas (each has one at most)."""
    a, b = (F.max(F.when(F.col("replica") == r, F.col("hash"))) for r in (0, 1))
    return rows.groupBy(*keys).agg(a.alias("a"), b.alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """archive, offset and state (``changed``, ``missing`` in the second replica,
    or ``extra`` there) of every record in which the replicas differ."""
    return audit_digests(digests(first), digests(second))


def audit_digests(first: DataFrame, second: DataFrame) -> DataFrame:
    """``audit`` of replicas whose records are hashed already (see ``digests``)."""
    leaf = stage(leaves(first).withColumn("replica", F.lit(0)).unionByName(leaves(second).withColumn("replica", F.lit(1))),
                 "merkle-leaves")
    most = leaf.agg(F.max(F.abs("offset"))).first()[0] or 0
    levels = 0
    while RANGE_BYTES * FANOUT ** levels <= most:
        levels += 1
    nodes = tree(leaf, levels)
    bad = _differing(nodes[-1], ["archive", "node"])
    for level in range(levels - 1, -1, -1):  # only children of a node that differs
        c, p = nodes[level].alias("c"), bad.alias("p")
        child = c.join(p, F.col("c.archive").eqNullSafe(F.col("p.archive"))
                       & F.floor(F.col("c.node") / FANOUT).cast("long").eqNullSafe(F.col("p.node")), "left_semi")
        bad = stage(_differing(child, ["archive", "node"]), f"merkle-bad-{level}")
    c, p = leaf.alias("c"), bad.alias("p")
    rows = c.join(p, F.col("c.archive").eqNullSafe(F.col("p.archive"))
                  & _range(0).eqNullSafe(F.col("p.node")), "left_semi")
    found = _differing(rows, ["archive", "offset"])
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return found.select("archive", "offset", state.alias("state"))


def damaged() -> Column:
    """A record in a second replica in which some have rotted, by the digest: the
    last byte of one in 97 is overwritten, and one in 101 is gone (null)."""
    draw = F.conv(F.substring(F.col("digest"), 1, 12), 16, 10).cast("long")
    cut = F.concat(F.expr("substring(record, 1, length - 1)"), F.lit("X").cast("binary"))
    return F.when(draw % 101 != 0, F.when(draw % 97 == 0, cut).otherwise(F.col("record")))


def report(pages: DataFrame) -> DataFrame:
    """The audit of a sound and a damaged replica of the pages' archives. Records
    are hashed where they are read; from there on only digests move."""
    hashed = warc_records(pages).withColumn("digest", F.sha2("record", 256)).withColumn("second", F.sha2(damaged(), 256))
    rows = stage(placed(hashed.drop("record")), "merkle-records")
    first = rows.select("archive", "offset", "length", "digest")
    second = rows.where("second is not null").select("archive", "offset", "length", F.col("second").alias("digest"))
    return audit_digests(first, second)


MERKLE_SQL = r"""
WITH r AS (SELECT floor(page_id / 1000)::BIGINT AS archive, page_id,
                  encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
                         || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
                         || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS record
           FROM pages),
d AS (SELECT *, sha256(record) AS digest FROM r),
o AS (SELECT *, coalesce(sum(octet_length(record)) OVER (PARTITION BY archive ORDER BY page_id NULLS FIRST, digest
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
             ('0x' || digest[1:12])::BIGINT AS draw FROM d)
SELECT archive, "offset", CASE WHEN draw % 101 = 0 THEN 'missing' ELSE 'changed' END AS state
FROM o WHERE draw % 101 = 0 OR draw % 97 = 0
"""
