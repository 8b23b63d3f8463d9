"""Prefix trie of conversations, built as burst tries.

A turn's id is 128 bits of the SHA-256 of its role and text, and a conversation is the row of its
turns' ids. Equal conversations are one row with their number, their smallest id and the digest of
their ids. Such rows are suffix containers under trie heads, at first one container under the root. A
container of over `limit` turns bursts by the next turn id: its head becomes a node, and its rows
move into a container for each next id. What bursts again bursts by the next two, four, ... ids
at once, so that the number of rounds follows the logarithm of the longest shared prefix. The
containers that are left have at most `limit` turns, or a single row; a task sorts the containers of its
shard and sweeps them into nodes with a stack.

A task holds the nodes of one container. Heads are few: each has over `limit` turns below it. The ids
of equal conversations are digested as a stream in order, after tasks that each see a range of them have
joined them to runs; so no task holds what many equal conversations have in common. A conversation is a
unit: the ids of its turns, 20 bytes each, are in one row, as every prefix of it is a node.

Turns are ordered by their number, nulls first, and turns of equal number by their id. Null roles and
texts are empty. Rows without a conversation id belong to none and take no part. Repeated rows are
turns of their own. c % 5 of a negative id is that of SQL, with the sign of c. A conversation that is
left without turns is a member of the root. Other columns are not read. An empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import cut, if_small

#: Bytes of a turn's id, and of the text of a run of conversation ids.
ID, RUN = 16, 1 << 16
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()


def digest(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 2 * ID))


def sequences(rows: DataFrame) -> DataFrame:
    """(base, conv_id, turns): the ordered turns (id, bytes) of each conversation, placed by base = c - c % 5."""
    role, text = F.coalesce(rows["role"], F.lit("")), F.coalesce(rows["text"], F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.select(
        rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].alias("turn"),
        digest(whole.cast("binary")).alias("id"), F.octet_length(text).alias("bytes"),
    ).where(F.col("conv_id").isNotNull())
    turns = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).repartition("base")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id", "bytes")))
    return turns.groupBy("base", "conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"], t["bytes"])).alias("turns"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): the first h turns of the base conversation, then the own turns after the first h."""
    own = cut(sequences(rows))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    first = own.where("conv_id = base").select("base", F.slice("turns", 1, 8).alias("start"))
    start = F.slice(F.coalesce("start", F.expr("slice(turns, 1, 0)")), F.lit(1), h)
    turns = F.concat(start, F.slice("turns", h + 1, F.size("turns")))
    joined = own.join(first, "base", "left").select("conv_id", turns.alias("turns"))
    return joined.select(
        "conv_id",
        # ids are joined as text of fixed width and turned back, which needs no function of its own
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("ids"),
        F.transform("turns", lambda t: t["bytes"]).alias("sizes"),
    )


def as_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal neighbours (key, conv_id, ids, sizes) joined to (key, conv_id, n, text, ids, sizes)."""
    names = ["key", "conv_id", "n", "text", "ids", "sizes"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int32())]

    def table(rows: list[list]) -> pa.RecordBatch:
        ready = [[k, c, n, ",".join(t), i, s] for k, c, n, t, i, s, _ in rows]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready, strict=True), kinds, strict=True)], names)

    held: list[list] = []
    size = 0
    for batch in batches:
        ids, sizes = batch.column(2), batch.column(3)
        for place, (key, conv) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            word = str(conv)
            if held and held[-1][0] == key and held[-1][6] + len(word) < RUN:
                row = held[-1]
                row[2] += 1
                row[3].append(word)
                row[6] += len(word) + 1
            else:
                if size > 1 << 22 or len(held) > 5000:
                    yield table(held)
                    held, size = [], 0
                held.append([key, conv, 1, [word], ids[place].as_py(), sizes[place].as_py(), len(word) + 1])
                size += len(held[-1][4])
            size += len(word)
    if held:
        yield table(held)


def as_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order as one row (key, conv_id, n, ends, ids, sizes) for each key; `ends` digests their texts."""
    names = ["key", "conv_id", "n", "ends", "ids", "sizes"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int32())]

    def table(rows: list[list]) -> pa.RecordBatch:
        ready = [[k, c, n, d.hexdigest(), i, s] for k, c, n, d, i, s in rows]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready, strict=True), kinds, strict=True)], names)

    held: list[list] = []
    size = 0
    for batch in batches:
        columns = batch.columns
        for place, (key, conv, n, text) in enumerate(zip(*[c.to_pylist() for c in columns[:4]], strict=True)):
            if held and held[-1][0] == key:
                held[-1][2] += n
                held[-1][3].update(b"," + text.encode())
            else:
                if size > 1 << 22 or len(held) > 5000:
                    yield table(held)
                    held, size = [], 0
                held.append([key, conv, n, hashlib.sha256(text.encode()), columns[4][place].as_py(), columns[5][place].as_py()])
                size += len(held[-1][4])
    if held:
        yield table(held)


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(key, conv_id, n, ends, ids, sizes): one row for each different sequence of turns."""
    keyed = cut(convs.select(digest(F.col("ids")).alias("key"), "conv_id", "ids", "sizes"))
    kind = "ids binary, sizes array<int>"
    # a range of rows cuts also the conversations that are all equal
    near = keyed.repartitionByRange(F.col("key"), F.col("conv_id")).sortWithinPartitions("key", "conv_id")
    runs = near.mapInArrow(as_runs, f"key binary, conv_id long, n long, text string, {kind}")
    ordered = runs.repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(as_members, f"key binary, conv_id long, n long, ends string, {kind}")


def prefix(ids: Column, depth: Column) -> Column:
    """The first `depth` ids; binary `substring` counts bytes."""
    return F.call_function("substring", ids, F.lit(1), (depth * ID).cast("int"))


def burst(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(rows, heads): the rows under their last head, and the heads.

    Rows gain `head`, `at` and `head_conv`: key, depth and smallest member of their head. A head is a prefix whose
    container has more than `limit` turns and more than one row; the root is always one.
    """
    length = F.octet_length("ids") / ID
    live = rows.withColumn("length", length.cast("int"))
    root = live.agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("conv_id is not null").select(
        digest(F.lit("").cast("binary")).alias("head"), F.lit(None).cast("binary").alias("parent"), F.lit("").cast("binary").alias("path"),
        F.lit(0).alias("depth"), F.lit(0).alias("bytes"), "n_convs", "conv_id",
    )
    heads = [cut(root)]
    top = heads[0].first()
    live = live.withColumns({
        "head": digest(F.lit("").cast("binary")), "at": F.lit(0), "head_conv": F.lit(top and top["conv_id"]).cast("long"),
    })
    done, step = [], 1
    while True:
        deeper = live.where(F.col("length") > F.col("at")).select(
            "key", "ids", "sizes", "n", "conv_id", "length",
            F.explode(F.sequence(F.col("at") + 1, F.least(F.col("length"), F.col("at") + F.lit(step)))).alias("depth"),
        )
        path = prefix(F.col("ids"), F.col("depth"))
        counted = deeper.groupBy(digest(path).alias("head")).agg(
            F.count("*").alias("rows"), F.sum(F.col("length") - F.col("depth")).alias("turns"), F.sum("n").alias("n_convs"),
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.min_by(F.struct("ids", "sizes"), "key").alias("one"),
        ).where((F.col("rows") > 1) & (F.col("turns") > limit))
        own = prefix(F.col("one.ids"), F.col("depth"))
        large = cut(counted.select(
            "head", digest(prefix(F.col("one.ids"), F.col("depth") - 1)).alias("parent"), own.alias("path"), "depth",
            F.element_at("one.sizes", F.col("depth")).alias("bytes"), "n_convs", "conv_id",
        ))
        if large.isEmpty():
            return _all([*done, live]), _all(heads)
        heads.append(large)
        known = if_small(large.select("head", F.col("conv_id").alias("head_conv")))
        # the deepest head of a row; sizes fall with depth, so that all prefixes before it are heads too
        moved = deeper.select("key", "depth", digest(path).alias("head")).join(known, "head").groupBy("key").agg(
            F.max_by(F.struct("head", F.col("depth").alias("at"), "head_conv"), "depth").alias("last")
        )
        base = [c for c in live.columns if c not in ("head", "at", "head_conv")]
        after = cut(live.join(moved, "key", "left").select(
            *base, F.coalesce("last.head", "head").alias("head"), F.coalesce("last.at", "at").alias("at"),
            F.coalesce("last.head_conv", "head_conv").alias("head_conv"),
            (F.coalesce("last.at", F.lit(-1)) == F.col("at") + step).alias("on"),
        ))
        done.append(after.where(~F.col("on")).drop("on"))
        live = after.where("on").drop("on")
        step *= 2


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose rows (container, head, at, head_conv, ids, sizes, n, conv_id, ends) come in order.

    The path to the current row is a stack of open nodes. A row closes those it does not share; a closed
    node adds to the one below it and names itself as its children's parent. The last two columns of a result tell
    for a container's top node (others: null) the head that it is a child of and its depth.
    """
    names = [*[c.split()[0] for c in NODE.split(", ")], "head", "of_head"]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.bool_()]
    out: list[list] = []
    stack: list[list] = []  # depth, conv_id, n, children, leaves, saved, ends, bytes, places of children in `out`
    current, path = None, b""
    under: tuple = ()

    def close(to: int) -> None:
        while stack and stack[-1][0] > to:
            depth, conv, n, children, leaves, saved, ends, size, places = stack.pop()
            saved += (n - 1) * size
            leaves = leaves or 1
            for place in places:
                out[place][2] = conv
            if stack:
                below = stack[-1]
                below[1] = min(below[1], conv)
                below[2] += n
                below[3] += 1
                below[4] += leaves
                below[5] += saved
                below[8].append(len(out))
                out.append([conv, depth, None, n, children, leaves, saved, ends, None, False])
            else:
                out.append([conv, depth, under[2], n, children, leaves, saved, ends, under[0], True])

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for batch in batches:
        small = zip(*[batch.column(i).to_pylist() for i in (0, 2, 3, 6, 7, 8)], strict=True)
        for place, (container, at, head_conv, n, conv, ends) in enumerate(small):
            ids, sizes = batch.column(4)[place].as_py(), batch.column(5)[place].as_py()
            if container != current:
                close(-1)
                if len(out) > 5000:
                    yield table()
                    out = []
                current, path, under = container, b"", (batch.column(1)[place].as_py(), at, head_conv)
            shared = at
            most = min(len(path), len(ids)) // ID
            if path:
                while shared < most and path[shared * ID : (shared + 1) * ID] == ids[shared * ID : (shared + 1) * ID]:
                    shared += 1
            close(shared)
            last = len(ids) // ID
            for depth in range(shared + 1, last + 1):
                stack.append([depth, conv, 0, 0, 0, 0, NOTHING, sizes[depth - 1], []])
            top = stack[-1]
            top[1], top[6] = min(top[1], conv), ends
            top[2] += n
            path = ids
    close(-1)
    if out:
        yield table()


def head_nodes(heads: DataFrame, tops: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes of the heads (head, parent, path, depth, bytes, n_convs, conv_id).

    `tops` are the nodes just under a head with that head, `ends` (head, ends) the sequences that end there.
    """
    below = tops.groupBy("head").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    inner = heads.groupBy(F.col("parent").alias("head")).agg(F.count("*").alias("inner"))
    known = cut(
        heads.join(below, "head", "left").join(inner, "head", "left").join(ends, "head", "left").withColumn(
            "n_children", F.coalesce("children", F.lit(0)) + F.coalesce("inner", F.lit(0))
        ).withColumn("leaves", F.coalesce("leaves", F.lit(0)) + F.when(F.col("n_children") == 0, 1).otherwise(0))
        .withColumn("saved", F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("bytes"))
    )
    # all prefixes of a head are heads: each head adds to them what is just below it
    above = known.select(
        "leaves", "saved", F.explode(F.transform(F.sequence(F.lit(0), F.col("depth")), lambda d: digest(prefix(F.col("path"), d)))).alias("head")
    )
    total = above.groupBy("head").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = known.select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return known.join(total, "head").join(parents, "parent", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


def prefix_trie(rows: DataFrame, limit: int = 1 << 16) -> DataFrame:
    """The nodes of the rebuilt conversations' trie, as `NODE` names their columns."""
    kept = rows.select(*[rows[c].alias(c) for c in ("conv_id", "turn", "role", "text")])
    placed, heads = burst(cut(distinct_sequences(rebuilt(kept))), limit)
    placed, heads = cut(placed), cut(heads)
    ends = placed.where(F.col("length") == F.col("at")).select("head", "ends")
    contained = placed.where(F.col("length") > F.col("at")).select(
        digest(prefix(F.col("ids"), F.col("at") + 1)).alias("container"), "head", "at", "head_conv", "ids", "sizes", "n", "conv_id", "ends"
    )
    shards = contained.repartition("container").sortWithinPartitions("container", "ids")
    swept = cut(shards.mapInArrow(sweep, f"{NODE}, head binary, of_head boolean"))
    return swept.drop("head", "of_head").unionByName(head_nodes(heads, swept.where("of_head"), ends))
