"""Merkle manifest of a dataset by butterfly exchange.

Rows are leaves in a fixed order; every ``FANOUT`` consecutive nodes hash to one, so
each group of rows (a source) has a subroot, and the subroots, in order, have the root
over them. Leaves are cut into aligned blocks of ``FANOUT ** DEPTH``, each a row of its
own that hashes its subtree alone. Blocks then exchange: in round r the up to
FANOUT blocks that differ in digit r of their number swap the roots of the aligned
subtrees they stand in, and each one hashes the common ancestor for itself. After
the last round every block holds its whole upper proof and the root, with nothing
passed back down. A round moves one row per block, whatever the skew of the sources.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.llm import kernel as K
from qualityforge.llm.staging import staged

FANOUT, DEPTH = 3, 6


def sha(content: Column) -> Column:
    """Lowercase hex SHA-256 of a text."""
    return F.sha2(F.encode(content, "UTF-8"), 256)


def leaf_of(*columns: Column) -> Column:
    """Digest of a row: each value as its length in UTF-8 bytes, a colon and itself, null as ``-``."""
    texts = [c.cast("string") for c in columns]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _join(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join([d.hex().encode() for d in digests])).digest()


def levels(nodes: list[bytes], depth: int | None, fanout: int) -> list[list[bytes]]:
    """All levels of a subtree from its leaves up: ``depth`` times, or until one node remains."""
    out = [nodes]
    while len(out[-1]) > 1 if depth is None else len(out) <= depth:
        last = out[-1]
        out.append([_join(last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return out


# ------------------------------------------------------------------------ order


def positions(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the place of every row in its ``grp``, and ``size``, the rows of the group.

    Rows are range-partitioned by (grp, order), so that a group of any size, and
    rows that tie in all of it, spread over tasks; the offsets of ranges come from one
    count per range and group.
    """
    spark = nodes.sparkSession
    # Equal rows are told apart by where they were read, only to spread them.
    by = ["grp", *order, "_seen"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.withColumn("_seen", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_seen")
    rows = staged(rows.withColumn("_at", F.monotonically_increasing_id()), "merkle-ordered")
    # The upper bits of the number are the range.
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    counts = rows.groupBy("grp", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = W.partitionBy("grp")
    before = F.sum("_n").over(group.orderBy("_range")) - F.col("_n") - F.col("_first")
    counts = staged(counts.select("grp", "_range", before.alias("_shift"), F.sum("_n").over(group).alias("size")), "merkle-counts")
    placed = rows.join(runtime.checked_broadcast(counts), ["grp", "_range"])
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


# ------------------------------------------------------------------------ blocks


def _subtrees(batches, depth: int, fanout: int):
    """Adds the root of each block's own subtree."""
    for batch in batches:
        members, sizes = batch.column("members"), batch.column("size").to_pylist()
        digests = pa.compute.struct_field(pa.compute.list_flatten(members), "digest").to_pylist()
        at, roots = 0, []
        for size, n in zip(sizes, pa.compute.list_value_length(members).to_pylist()):
            own = levels(digests[at : at + n], None if size <= fanout**depth else depth, fanout)
            roots.append(own[-1][0])
            at += n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.binary())], names=[*batch.schema.names, "node"])


def blocks(nodes: DataFrame, payload: list[str], depth: int = DEPTH, fanout: int = FANOUT) -> DataFrame:
    """(grp, block, size, members, node): a row per aligned block of ``fanout ** depth``
    nodes; ``members`` are (pos, digest, payload...) in order, ``node`` the subtree's root."""
    per = fanout**depth
    member = F.struct("pos", "digest", *payload)
    rows = nodes.groupBy("grp", F.expr(f"pos div {per}").alias("block")).agg(F.first("size").alias("size"), F.array_sort(F.collect_list(member)).alias("members"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", node binary"
    return staged(rows.mapInArrow(K.task(_subtrees, depth, fanout), schema), "merkle-blocks")


def butterfly(rows: DataFrame, depth: int = DEPTH, fanout: int = FANOUT) -> DataFrame:
    """(grp, block, upper, top): per block the siblings of its ancestors, level by level as
    (left, right) texts, and the root of its group.

    In round r a block of number b meets those with the same b div fanout^(r+1) and
    b mod fanout^r. An incomplete last subtree has no block for some remainders;
    its blocks stand in for those.
    """
    per = fanout**depth
    state = rows.select(
        "grp", "block", F.expr(f"(size + {per - 1}) div {per}").alias("n"), F.col("node").alias("top"), F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("upper")
    )
    most = state.agg(F.max("n")).first()[0] or 1
    step = 1
    while step < most:
        # Number of aligned subtrees of this size, and whether the block is in the last one.
        run, digit, low = F.expr(f"block div {step * fanout}"), F.expr(f"(block div {step}) % {fanout}"), F.expr(f"block % {step}")
        busy, last = F.col("n") > step, F.expr(f"block div {step} = (n - 1) div {step}")
        present = F.expr(f"n - ((n - 1) div {step}) * {step}")
        seats = F.when(busy & last, F.sequence(low, F.lit(step - 1).cast("long"), present)).otherwise(F.array(low))
        sent = state.select("*", run.alias("run"), digit.alias("digit"), low.alias("low"), busy.alias("busy"), F.explode(seats).alias("seat"))
        # A block whose group is done meets nobody.
        sent = sent.withColumn("run", F.when(F.col("busy"), F.col("run")).otherwise(-1 - F.col("block")))
        own = F.when(F.col("seat") == F.col("low"), F.struct("block", "n", "upper"))
        met = sent.groupBy("grp", "run", "seat").agg(F.array_sort(F.collect_list(F.struct("digit", "top", "busy", own.alias("own")))).alias("met"))
        met = met.withColumn("all", F.concat_ws("", F.transform("met", lambda m: F.lower(F.hex(m["top"])))))
        met = met.select("grp", "met", "all", F.posexplode("met").alias("at", "m")).filter("m.own is not null")
        left = F.substring("all", F.lit(1), F.col("at") * 64)
        right = F.expr("substring(all, (at + 1) * 64 + 1)")
        climbs = F.col("m.busy")
        state = met.select(
            "grp",
            F.col("m.own.block").alias("block"),
            F.col("m.own.n").alias("n"),
            F.when(climbs, F.unhex(sha(F.col("all")))).otherwise(F.col("m.top")).alias("top"),
            F.when(climbs, F.array_append("m.own.upper", F.struct(left.alias("left"), right.alias("right")))).otherwise(F.col("m.own.upper")).alias("upper"),
        )
        step *= fanout
    return staged(state.select("grp", "block", "upper", "top"), "merkle-proofs")


# ------------------------------------------------------------------------- proofs


def _fold(batches, depth: int, fanout: int):
    """The proof and the folded digest of every member of a block."""
    H = hashlib.sha256
    for batch in batches:
        rows = batch.select(["members", "size", "upper", "over"]).to_pylist()
        keys, leaves, proofs, folded = [], [], [], []
        for row in rows:
            members = row["members"]
            tree = levels([m["digest"] for m in members], None if row["size"] <= fanout**depth else depth, fanout)
            texts = [[d.hex().encode() for d in level] for level in tree]
            above = [(s["left"].encode(), s["right"].encode()) for s in [*row["upper"], *row["over"]]]
            rest = b"".join(x + y for x, y in above)
            for i, m in enumerate(members):
                proof, node, at = H(), m["claimed"].hex().encode(), i
                for level in texts[:-1]:
                    run = at - at % fanout
                    left, right = b"".join(level[run:at]), b"".join(level[at + 1 : run + fanout])
                    proof.update(left + right)
                    node, at = H(left + node + right).hexdigest().encode(), at // fanout
                proof.update(rest)
                for left, right in above:
                    node = H(left + node + right).hexdigest().encode()
                keys.append(m["key"])
                leaves.append(m["digest"].hex())
                proofs.append(proof.hexdigest())
                folded.append(node.decode())
        sizes = [len(r["members"]) for r in rows]
        each = pa.array([i for i, n in enumerate(sizes) for _ in range(n)], pa.int64())
        kind = batch.schema.field("members").type.value_type.field("key").type
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, kind), *[pa.array(c, pa.string()) for c in (leaves, proofs, folded)], *[batch.column(c).take(each) for c in ("subroot", "root")]],
            names=["key", "leaf", "proof_sha256", "folded_root", "subroot", "root"],
        )


def _seat_proofs(batches, depth: int, fanout: int):
    """For members that are groups themselves: their siblings at all levels and the root."""
    for batch in batches:
        groups, overs, tops = [], [], []
        for row in batch.select(["members", "size", "upper", "top"]).to_pylist():
            tree = levels([m["digest"] for m in row["members"]], None if row["size"] <= fanout**depth else depth, fanout)
            texts = [[d.hex() for d in level] for level in tree]
            for i, m in enumerate(row["members"]):
                over, at = [], i
                for level in texts[:-1]:
                    run = at - at % fanout
                    over.append({"left": "".join(level[run:at]), "right": "".join(level[at + 1 : run + fanout])})
                    at //= fanout
                groups.append(m["key"])
                overs.append([*over, *row["upper"]])
                tops.append(row["top"])
        side = pa.struct([("left", pa.string()), ("right", pa.string())])
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(overs, pa.list_(side)), pa.array(tops, pa.binary())], names=["grp", "over", "root"])


def manifest(
    docs: DataFrame, key: str, group: str, leaf: Column, claimed: Column | None = None, depth: int = DEPTH, fanout: int = FANOUT
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``leaf`` is the hex digest of a row, ``claimed`` the digest to be proven (by default
    the leaf); ``folded_root`` is computed from the claimed digest with the true
    siblings, ``verified`` tells whether it is the root. Groups are ordered by the bytes of
    their text, null first, rows within by key, null first; rows that repeat a key
    are ordered by their digests, and equal rows are interchangeable. An empty table
    gives no rows. Columns named by neither argument are not read.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        # Null comes first and is told from the empty text.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.unhex(leaf).alias("digest"),
        F.unhex(leaf if claimed is None else claimed).alias("claimed"),
    )
    lower = blocks(positions(rows, ["key", "digest", "claimed"]), ["key", "claimed"], depth, fanout)
    proofs = butterfly(lower, depth, fanout)
    subroots = proofs.groupBy("grp").agg(F.first("top").alias("digest"))
    seats = positions(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest"), ["key"])
    upper = blocks(seats, ["key"], depth, fanout)
    placed = upper.join(butterfly(upper, depth, fanout), ["grp", "block"])
    over = placed.select("members", "size", "upper", "top").mapInArrow(K.task(_seat_proofs, depth, fanout), "grp string, over array<struct<left:string,right:string>>, root binary")
    # Proofs are joined to small rows first, then once to the blocks they belong to.
    whole = staged(proofs.join(runtime.checked_broadcast(staged(over, "merkle-over")), "grp"), "merkle-whole")
    whole = whole.select("grp", "block", "upper", "over", F.lower(F.hex("top")).alias("subroot"), F.lower(F.hex("root")).alias("root"))
    kind = rows.schema["key"].dataType.simpleString()
    out = lower.select("grp", "block", "size", "members").join(whole, ["grp", "block"])
    out = out.mapInArrow(K.task(_fold, depth, fanout), f"key {kind}, leaf string, proof_sha256 string, folded_root string, subroot string, root string")
    return out.select(F.col("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
