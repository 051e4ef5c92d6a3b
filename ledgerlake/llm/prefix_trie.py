"""Conversation prefix trie, built as a burst trie.

A conversation is one binary string of its turns' ids, 24 bytes a turn: 16 bytes of the SHA-256 of (role, text), then the
text's UTF-8 length.  Strings that share a prefix sit in one *container* under the trie node of that prefix, the
container's head.  All strings start in the root's container, which is always burst; any other container bursts while
it holds more than ``convs`` strings or ``turns`` turns.  A burst first walks down the turns that all strings share (the
common prefix of the least and the greatest string, two aggregates), so a group of copies is done in one burst; strings
that end there end at that node, and every other string goes to the container of its next turn id.  What is left are
small containers, dealt over the cluster by head; each is sorted and swept once, with a stack of open nodes.  Sums over
subtrees come out of the sweep and are then added up over the few heads, from the last burst back to the root.

The conversation ids that end at one head can be many: they are joined to chunks in ranges over the cluster, and one
stream of chunks, not of rows, feeds the head's hash.

Defined cases: rows with a null conversation id take no part; null role or text counts as empty; a null turn comes first;
equal turns of one conversation are ordered by their turn id; repeated rows are repeated turns; an empty table gives no
node, not even a root; other columns are ignored.  A conversation is one row: its ids (24 bytes a turn) must fit one.
Strings that are prefixes of one another with ever later ends burst once per end, as in any trie without compression of
ends.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

W = 24   # bytes of a turn id
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, " \
        "saved_tokens long, ends_sha256 string"
NAMES = [c.split()[0] for c in NODES.split(", ")]


def turn_sequences(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv, seq): every conversation's turn ids in order.  Only ids are shuffled, never texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn_id = F.concat(F.substring(said, 1, 32), F.lpad(F.hex(F.octet_length(text)), 16, "0"))
    rows = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.struct(F.col(turn_col).alias("t"), turn_id.alias("id")).alias("turn"))
    turns = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv").agg(F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), "")).alias("seq"))


def with_other_heads(seqs: DataFrame, other, n_turns, most: int) -> DataFrame:
    """Every conversation with its first ``n_turns`` turns taken from the conversation ``other`` instead (all of that
    one's, if fewer; none, if it is absent).  Both are columns over ``conv``; ``n_turns`` is ``most`` at most."""
    heads = seqs.select(F.col("conv").alias("other"), F.col("seq").substr(1, most * W).alias("head"))
    own = seqs.withColumns({"other": other, "cut": (n_turns * W).cast("int")})
    head = F.coalesce(F.col("head"), F.lit(b"")).substr(F.lit(1), F.col("cut"))
    rest = F.col("seq").substr(F.col("cut") + 1, F.greatest(F.octet_length("seq") - F.col("cut"), F.lit(0)))
    return own.join(heads, "other", "left").select("conv", F.concat(head, rest).alias("seq"))


def _shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Number of leading turns that are equal, given that ``start`` are."""
    n, most = start, min(len(a), len(b)) // W
    while n < most and a[n * W:n * W + W] == b[n * W:n * W + W]:
        n += 1
    return n


def _text_bytes(seq: bytes, depth: int) -> int:
    return int.from_bytes(seq[depth * W - 8:depth * W], "big") if depth else 0


def sweep(rows: list[tuple[bytes, int]], top: int, up: int | None) -> list[list]:
    """The nodes (as NAMES) of one container: its strings (seq, conv) in order, all with the same first ``top`` turns.
    The first node is the container's top."""
    parent, depth, first, count, ends, cost = [], [], [], [], [], []
    stack, last = [], b""
    for seq, conv in rows:
        same = _shared(last, seq, top) if stack else top - 1
        del stack[max(same - top + 1, 0):]
        for d in range(same + 1, len(seq) // W + 1):
            parent.append(stack[-1] if stack else -1)
            stack.append(len(depth))
            depth.append(d)
            first.append(conv)
            count.append(0)
            ends.append([])
            cost.append(_text_bytes(seq, d))
        for i in stack:
            count[i] += 1
            if conv < first[i]:
                first[i] = conv
        ends[stack[-1]].append(conv)
        last = seq
    n = len(depth)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):   # children come after their parent
        leaves[i] = leaves[i] or 1
        saved[i] += (count[i] - 1) * cost[i]
        if (p := parent[i]) >= 0:
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    return [[first[i], depth[i], up if parent[i] < 0 else first[parent[i]], count[i], children[i], leaves[i], saved[i],
             hashlib.sha256(",".join(map(str, sorted(ends[i]))).encode()).hexdigest()] for i in range(n)]


def _batches(rows, names, types, size: int = 20_000):
    """Record batches of at most about ``size`` rows from an iterator of rows."""
    out = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


NODE_TYPES = [pa.int64()] * 7 + [pa.string()]


def _sweep_partition(batches):
    """Containers (head, top, up, up_head, seq, conv) in order -> nodes; a container's first node carries up_head."""
    def nodes():
        head, about, rows = None, None, []
        for b in batches:
            for h, top, up, up_head, seq, conv in zip(*(c.to_pylist() for c in b.columns)):
                if h != head:
                    if rows:
                        yield from done(about, rows)
                    head, about, rows = h, (top, up, up_head), []
                rows.append((seq, conv))
        if rows:
            yield from done(about, rows)

    def done(about, rows):
        top, up, up_head = about
        for i, node in enumerate(sweep(rows, top, up)):
            yield [*node, up_head if i == 0 else None]
    return _batches(nodes(), [*NAMES, "up_head"], [*NODE_TYPES, pa.binary()])


def _walk_down(batches):
    """Heads (head, top, n, first, up, up_head, lo, hi) -> lcp, the turns that all strings share, and their text bytes
    from the top on."""
    for b in batches:
        tops = b.column(1).to_pylist()
        los, his = b.column(6).to_pylist(), b.column(7).to_pylist()
        lcps = [_shared(lo, hi, t) for lo, hi, t in zip(los, his, tops)]
        costs = [[_text_bytes(lo, d) for d in range(t, m + 1)] for lo, t, m in zip(los, tops, lcps)]
        yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(lcps, pa.int32()), pa.array(costs, pa.list_(pa.int64()))],
                                         names=["head", "top", "n", "first", "up", "up_head", "lcp", "costs"])


def _join_ids(batches, most: int = 1024):
    """(head, conv) in order -> (head, first conv, decimal ids joined by commas), up to ``most`` ids a row."""
    def chunks():
        head, ids = None, []
        for b in batches:
            for h, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if h != head or len(ids) == most:
                    if ids:
                        yield head, ids[0], ",".join(map(str, ids))
                    head, ids = h, []
                ids.append(c)
        if ids:
            yield head, ids[0], ",".join(map(str, ids))
    return _batches(chunks(), ["head", "first", "ids"], [pa.binary(), pa.int64(), pa.string()], 200)


def _hash_chunks(batches):
    """(head, first, ids) in order -> (head, SHA-256 of all its ids joined by commas)."""
    def heads():
        head, sha = None, None
        for b in batches:
            for h, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if h != head:
                    if sha:
                        yield head, sha.hexdigest()
                    head, sha = h, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if sha:
            yield head, sha.hexdigest()
    return _batches(heads(), ["head", "ends_sha256"], [pa.binary(), pa.string()])


def _head_nodes(batches):
    """Heads with their children's sums -> one node per turn walked down; only the last has children and ends."""
    nothing = hashlib.sha256(b"").hexdigest()

    def nodes():
        for b in batches:
            for r in b.to_pylist():
                saved = r["saved_below"]
                for d in range(r["lcp"], r["top"] - 1, -1):
                    saved += (r["n"] - 1) * r["costs"][d - r["top"]]
                    last = d == r["lcp"]
                    yield [r["first"], d, r["up"] if d == r["top"] else r["first"], r["n"],
                           r["children"] if last else 1, r["leaves"], saved, r["ends_sha256"] if last else nothing]
    return _batches(nodes(), NAMES, NODE_TYPES)


def _ends_digest(ends: DataFrame, partitions: int) -> DataFrame:
    chunks = ends.repartitionByRange(partitions, "head", "conv").sortWithinPartitions("head", "conv").mapInArrow(
        _join_ids, "head binary, first long, ids string")
    return chunks.repartition(partitions, "head").sortWithinPartitions("head", "first").mapInArrow(
        _hash_chunks, "head binary, ends_sha256 string")


def prefix_trie(seqs: DataFrame, convs: int = 128, turns: int = 65_536) -> DataFrame:
    """The nodes (see NAMES) of the trie over (conv, seq); ``conv`` is distinct.  parent_conv_id is the parent's smallest
    conversation; a node is known by its smallest conversation and depth."""
    spark = seqs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = materialise(seqs.select(F.lit(b"").alias("head"), F.lit(0).alias("top"), F.lit(None).cast("long").alias("up"),
                                      F.lit(None).cast("binary").alias("up_head"), "seq", "conv"), "trie-members")
    left, heads, ends = [], [], []
    while True:
        size = members.groupBy("head").agg(
            F.count("*").alias("n"), F.sum(F.octet_length("seq") / W - F.col("top")).alias("t"),
            F.min("conv").alias("first"), F.max("top").alias("at"))
        big = materialise(size.filter((F.col("at") == 0) | ((F.col("n") > 1) & ((F.col("n") > convs) | (F.col("t") > turns))))
                          .select("head", "n", "first"), "trie-big")
        if big.isEmpty():
            left.append(members)
            break
        sorted_out = materialise(members.join(big, "head", "left"), "trie-sorted-out")
        left.append(sorted_out.filter("n is null").select(members.columns))
        over = sorted_out.filter("n is not null")
        # every column but seq is the same for all strings of a head
        walked = materialise(over.groupBy("head").agg(
            F.max("top").alias("top"), F.max("n").alias("n"), F.max("first").alias("first"), F.max("up").alias("up"),
            F.max("up_head").alias("up_head"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).mapInArrow(
                _walk_down, "head binary, top int, n long, first long, up long, up_head binary, lcp int, costs array<long>"),
            "trie-heads")
        heads.append(walked)
        at = over.select("head", "seq", "conv").join(walked.select("head", "lcp", "first"), "head")
        past = F.octet_length("seq") > F.col("lcp") * W
        ends.append(at.filter(~past).select("head", "conv"))
        after = F.col("seq").substr(F.col("lcp") * W + 1, F.lit(W))
        members = materialise(at.filter(past).select(
            F.unhex(F.md5(F.concat("head", after))).alias("head"), (F.col("lcp") + 1).alias("top"),
            F.col("first").alias("up"), F.col("head").alias("up_head"), "seq", "conv"), "trie-members")

    strings = left[0]
    for more in left[1:]:
        strings = strings.unionAll(more)
    swept = materialise(strings.repartition(partitions, "head").sortWithinPartitions("head", "seq", "conv").mapInArrow(
        _sweep_partition, f"{NODES}, up_head binary"), "trie-swept")
    if not heads:
        return swept.drop("up_head")
    every_end = ends[0]
    for more in ends[1:]:
        every_end = every_end.unionAll(more)
    digest = materialise(_ends_digest(every_end, partitions), "trie-ends")
    below = materialise(swept.filter("up_head is not null").groupBy(F.col("up_head").alias("head")).agg(
        F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")), "trie-below")
    nodes, summed = swept.drop("up_head"), below
    for walked in reversed(heads):
        total = F.aggregate("costs", F.lit(0).cast("long"), lambda a, c: a + c)
        h = materialise(walked.join(summed, "head", "left").join(digest, "head", "left").select(
            *walked.columns, F.coalesce("c", F.lit(0)).alias("children"), F.coalesce("l", F.lit(1)).alias("leaves"),
            F.coalesce("s", F.lit(0)).alias("saved_below"),
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256")), "trie-summed")
        nodes = nodes.unionAll(h.mapInArrow(_head_nodes, NODES))
        own = h.groupBy(F.col("up_head").alias("head")).agg(
            F.count("*").alias("c"), F.sum("leaves").alias("l"),
            F.sum(F.col("saved_below") + (F.col("n") - 1) * total).alias("s"))
        summed = below.unionAll(own).groupBy("head").agg(F.sum("c").alias("c"), F.sum("l").alias("l"), F.sum("s").alias("s"))
    return nodes


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", convs: int = 128, turns: int = 65_536) -> DataFrame:
    """The prefix trie of the conversations as they are."""
    return prefix_trie(turn_sequences(df, conv_col, turn_col, role_col, text_col), convs, turns)
