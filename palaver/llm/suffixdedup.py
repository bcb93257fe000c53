"""Removal of byte strings that occurred earlier, by a distributed merge sort of sampled suffixes.

Every window of `length` bytes that equals an earlier one is removed, judged on the input. The suffix
array is sparse: a window is represented by the suffix that starts at its anchor, the leftmost of its
`gram`-byte substrings with the least hash. Equal windows have equal anchors at equal offsets, so
nothing is lost, and an anchor serves the dozens of windows around it. Steps, all over blocks of
documents dealt by a hash of their key:

1. Anchor hashes that occur twice or more in the corpus are found; other windows cannot repeat. A sample of
   them brings the first bytes of its suffixes, which part the order of suffixes into ranges.
2. Each block sorts the suffixes at such anchors (100 bytes to the right, up to 60 to the left kept
   beside them) into a run, removes what repeats within the block, and so passes on each window once
   at most: a passage in a third of all documents is one entry per block.
3. Runs are front-coded (length of the prefix shared with the entry before, then the rest), cut at range
   borders and exchanged. A loser tree merges FAN runs of neighbouring blocks over one range; it carries for
   each run the length of the prefix shared with the last winner, as the front coding brought it, and
   compares bytes beyond equal lengths only. The merged order comes with its own shared-prefix lengths;
   these, with the same lengths over the left contexts, tell which windows are equal, and all but the
   earliest are removed. What is left is a longer run; it is cut at finer borders and merged with its
   neighbours again, until one run is left of each range: as many levels as FAN makes of the blocks' number.
   So a level moves FAN runs for each block, however many blocks there are.
4. Removed windows go back to their block, where they are united and cut from the text.

The texts are shuffled once for step 1 and once for the others. Whole copies of an earlier text are set
aside first, by digest: all their bytes occurred before.

Defined cases: a null text is empty; texts shorter than `length` lose nothing by copies; long texts are read
whole, in chunks; a document is its id (which must be a whole number) and text together, so rows that repeat
both are one document and each gets the same result; documents that share an id are ordered by digest; a
null id comes before all others; an empty table gives an empty result; any other columns are passed on
untouched if named in `keep`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import join_sized, n_blocks, stored, table
from palaver.shipping import ship

LENGTH = 100
GRAM = 40
#: Starts of grams in a window; offsets of an anchor are bits of one 64-bit word.
SPAN = LENGTH - GRAM + 1
LEFT = SPAN - 1
BLOCK_BYTES = 12 << 20
#: Positions that are hashed at a time; their low bits hold the place in the chunk.
CHUNK_BITS = 18
COPY, ANCHOR, CUT = 0, 1, 2
SIDE = "block int, kind int, a long, b long, c long, d long"
RUNS = "part long, kind int, run binary"
#: Runs that are merged at a time, blocks whose entries make one range in the end, and sampled suffixes for each range.
FAN, RANGE_BLOCKS, SAMPLED = 64, 8, 16
#: Bytes of text for each different anchor that repeats, at the least; the sample is cut down if there are more.
REPEATED_EVERY = 1600
C1, C2, C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    t = a * C1
    t += b * C2
    t ^= t >> np.uint64(32)
    t *= C3
    t ^= t >> np.uint64(29)
    return t


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each GRAM bytes of data (40: twice sixteen and eight, put together)."""
    x = data.astype(np.uint64)
    x = x[:-1] | (x[1:] << np.uint64(8))
    x = x[:-2] | (x[2:] << np.uint64(16))
    x = x[:-4] | (x[4:] << np.uint64(32))
    h16 = _mix(x[:-8], x[8:])
    h32 = _mix(h16[:-16], h16[16:])
    return _mix(h32[: len(data) - GRAM + 1], x[32:])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window start of data: its anchor's place; and the hash at every place."""
    h = gram_hashes(data)
    mask = np.uint64((1 << CHUNK_BITS) - 1)
    m = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= SPAN:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < SPAN:
        m = np.minimum(m[: len(h) - SPAN + 1], m[SPAN - size :])
    return (m & mask).astype(np.int64), h


def chunks(n: int):
    """(first, last + 1) bytes of chunks whose windows, together, are those of n bytes, each once."""
    step = (1 << CHUNK_BITS) - LENGTH
    for at in range(0, max(n - LENGTH + 1, 0), step):
        yield at, min(n, at + step + LENGTH - 1)


class Block:
    """The documents of one block: bytes put together, where each starts, and their keys."""

    def __init__(self, docs: pa.Table, side: pa.Table):
        text = docs.column("__text").combine_chunks() if docs.num_rows else pa.array([], pa.large_string())
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.large_string())
        text = text.cast(pa.large_binary())
        self.n = len(text)
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        self.data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        self.start, self.end = offsets[:-1], offsets[1:]
        self.ids, self.ties = (docs.column(c).to_numpy() if self.n else np.empty(0, np.int64) for c in ("__id", "__tie"))
        kind = side.column("kind").to_numpy()
        self.side = {k: [side.column(c).to_numpy()[kind == k] for c in "abcd"] for k in (COPY, ANCHOR, CUT)}
        place: dict[tuple[int, int], list[int]] = {}
        for i, key in enumerate(zip(self.ids.tolist(), self.ties.tolist(), strict=True)):
            place.setdefault(key, []).append(i)
        self.rows = place
        self.copy = {key for key in zip(self.side[COPY][0].tolist(), self.side[COPY][1].tolist(), strict=True)}
        #: One row of each document that is no copy.
        self.own = np.array([v[0] for k, v in place.items() if k not in self.copy], np.int64)

    def found(self):
        """Chunk by chunk: document row, its anchors' places in the document, first and last window start, hash."""
        lengths = self.end - self.start
        for i in self.own[lengths[self.own] >= LENGTH].tolist():
            text = self.data[self.start[i] : self.end[i]]
            for a, b in chunks(len(text)):
                pos, h = anchors(text[a:b])
                first = np.concatenate(([0], np.flatnonzero(pos[1:] != pos[:-1]) + 1))
                last = np.concatenate((first[1:], [len(pos)])) - 1
                place = pos[first]
                yield i, place + a, first + a, last + a, h[place]


def emit_anchors(rate: int):
    """Step 1: anchor hashes of the block with their counts (2 at most), and the gram of one in `rate` of them."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left, right)
        hashes, places = [], []
        for i, place, _, _, h in block.found():
            hashes.append(h)
            places.append(place + block.start[i])
        none = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        key, at, n = np.unique(np.concatenate(hashes), return_index=True, return_counts=True) if hashes else none
        grams = np.full(len(key), None, object)
        place = np.concatenate(places) if places else none[1]
        for k in np.flatnonzero(key % np.uint64(rate) == 0):
            begin = place[at[k]]
            grams[k] = block.data[begin : begin + GRAM].tobytes()
        number = left.column("block")[0].as_py() if left.num_rows else 0
        return pa.table({"key": key.view(np.int64), "block": np.full(len(key), number, np.int32), "n": np.minimum(n, 2).astype(np.int32), "gram": pa.array(grams, pa.binary())})

    return run


class Ranges:
    """Where entries go: ranges of suffixes, and the groups of blocks and ranges that meet at each level."""

    def __init__(self, grams: list[bytes], blocks: int, fan: int):
        self.levels, self.fan = 1, fan
        while fan**self.levels < blocks:
            self.levels += 1
        self.borders = np.array(sorted(set(grams)), f"S{GRAM}")
        self.n = len(self.borders) + 1

    def of(self, suffix: np.ndarray) -> np.ndarray:
        """Number of each suffix's range; suffixes are rows of bytes."""
        grams = np.ascontiguousarray(suffix[:, :GRAM]).view(f"S{GRAM}").ravel()
        return np.searchsorted(self.borders, grams, side="right")

    def part(self, level: int, first: int, ranges: np.ndarray) -> np.ndarray:
        """The group at a level; first: number of the group of fan**level blocks."""
        each = self.fan**level
        return first * each + ranges * min(self.n, each) // self.n

    def first(self, level: int, part: int) -> int:
        return part // self.fan**level


def shared(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before; 0 for the first."""
    if not len(rows):
        return np.empty(0, np.int64)
    unlike = rows[1:] != rows[:-1]
    return np.concatenate(([0], np.where(unlike.any(axis=1), unlike.argmax(axis=1), rows.shape[1])))


def repeats(lcp: np.ndarray, left: np.ndarray, masks: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For suffixes in order, with shared-prefix lengths and reversed left contexts: bits of the offsets at
    which an entry's window equals that of an entry of lower rank."""
    n = len(lcp)
    out = np.zeros(n, np.uint64)
    if n < 2:
        return out
    by_left = np.argsort(left.view(f"S{left.shape[1]}").ravel(), kind="stable")
    lcs = shared(left[by_left])
    left_class = np.empty(n, np.int64)
    for o in range(SPAN):
        bit = np.uint64(1 << o)
        rows = np.flatnonzero(masks & bit)
        if len(rows) < 2:
            continue
        left_class[by_left] = np.cumsum(lcs < o) if o else 0
        right_class = np.cumsum(lcp < LENGTH - o)
        a, b = right_class[rows], left_class[rows]
        order = np.lexsort((rank[rows], b, a))
        a, b = a[order], b[order]
        again = np.concatenate(([False], (a[1:] == a[:-1]) & (b[1:] == b[:-1])))
        out[rows[order[again]]] |= bit
    return out


def cut_up(ranges: Ranges, level: int, first: int, entries) -> list[tuple[int, int, bytes]]:
    """Rows (part, kind, run) of entries in order, one for each group of the level that they go to.

    entries: shared-prefix lengths, suffixes, their lengths, left contexts, ids, ties, places, masks.
    """
    if not len(entries[0]):
        return []
    target = ranges.part(level, first, ranges.of(entries[1]))
    edges = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1], [True])))
    return [(int(target[a]), ANCHOR, front_code(*(x[a:b] for x in entries))) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def as_runs(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, kind, run = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"part": pa.array(part, pa.int64()), "kind": pa.array(kind, pa.int32()), "run": pa.array(run, pa.binary())})


def packed_cuts(ids, ties, place, cut) -> bytes:
    return b"".join(x.tobytes() for x in (ids, ties, place, cut))


def emit_runs(sent):
    """Step 2: one row per target with the block's front-coded run, and one with what repeats inside the block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, ranges = Block(left, right), sent.value
        known = np.sort(block.side[ANCHOR][0]).view(np.int64)
        fields: list[list[np.ndarray]] = [[] for _ in range(4)]
        if len(known):
            for i, place, first, last, h in block.found():
                h = h.view(np.int64)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                use = known[at] == h
                if use.any():
                    for f, x in zip(fields, (np.full(use.sum(), i), place[use], place[use] - last[use], place[use] - first[use]), strict=True):
                        f.append(x)
        if not fields[0]:
            return as_runs([])
        number = left.column("block")[0].as_py() // ranges.fan
        row, place, low, high = (np.concatenate(f) for f in fields)
        right_len = LENGTH - low
        base = block.start[row] + place
        cols = np.arange(LENGTH)
        size = len(block.data) - 1
        suffix = block.data[np.minimum(base[:, None] + cols, size)]
        suffix[cols >= right_len[:, None]] = 0
        cols = np.arange(LEFT)
        context = block.data[np.maximum(base[:, None] - 1 - cols, 0)]
        context[cols >= high[:, None]] = 0
        masks = ((np.uint64(2) << high.astype(np.uint64)) - np.uint64(1)) & ~((np.uint64(1) << low.astype(np.uint64)) - np.uint64(1))
        ids, ties = block.ids[row], block.ties[row]
        order = np.argsort(suffix.view(f"S{LENGTH}").ravel(), kind="stable")
        place, suffix, context, masks, ids, ties, right_len = (x[order] for x in (place, suffix, context, masks, ids, ties, right_len))
        rank = np.empty(len(row), np.int64)
        rank[np.lexsort((place, ties, ids))] = np.arange(len(row))
        lcp = shared(suffix)
        cut = repeats(lcp, context, masks, rank)
        some = cut != 0
        out = [(int(ranges.part(1, number, np.zeros(1, np.int64))[0]), CUT, packed_cuts(ids[some], ties[some], place[some], cut[some]))] if some.any() else []
        masks &= ~cut
        rest = np.flatnonzero(masks)
        return as_runs(out + cut_up(ranges, 1, number, (fewer(lcp, rest), *(x[rest] for x in (suffix, right_len, context, ids, ties, place, masks)))))

    return run


def fewer(lcp: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Shared-prefix lengths of the entries that stay: the least of those passed over since the one before."""
    if not len(rest):
        return np.empty(0, np.int64)
    out = np.minimum.reduceat(lcp, np.concatenate(([0], rest[:-1] + 1)))
    # A segment ends with the entry itself; what stands behind the last one belongs to none.
    out[-1] = lcp[rest[-2] + 1 : rest[-1] + 1].min() if len(rest) > 1 else 0
    out[0] = 0
    return out


def front_code(lcp, suffix, right_len, context, ids, ties, place, masks) -> bytes:
    """A sorted run: count; per entry the prefix that its padded row shares, the suffix's length, the shared prefix of
    the left context, then its document, place and offsets; then the bytes that are not shared."""
    n = len(ids)
    lcp = np.concatenate(([0], lcp[1:])).astype(np.uint8)  # the run's first entry shares nothing
    lcs = shared(context).astype(np.uint8)
    cols = np.arange(LENGTH)
    tail = suffix[(cols >= lcp[:, None]) & (cols < right_len[:, None])]
    left_tail = context[np.arange(LEFT) >= lcs[:, None]]
    head = np.array([n], np.int64).tobytes()
    return b"".join((head, lcp.tobytes(), right_len.astype(np.uint8).tobytes(), lcs.tobytes(), ids.tobytes(), ties.tobytes(), place.tobytes(), masks.tobytes(), tail.tobytes(), left_tail.tobytes()))


def read_run(data: bytes):
    """What `front_code` wrote: shared-prefix lengths, suffixes (rows of bytes), their lengths, left contexts, ids, ties,
    places, masks."""
    n = int(np.frombuffer(data, np.int64, 1)[0])
    at = 8
    got = []
    for kind in (np.uint8,) * 3 + (np.int64,) * 3 + (np.uint64,):
        got.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    lcp, right_len, lcs, ids, ties, place, masks = got
    rows = []
    for width, keep, length in ((LENGTH, lcp, right_len.astype(np.int64)), (LEFT, lcs, np.full(n, LEFT))):
        cols = np.arange(width)
        fresh = (cols >= keep[:, None]) & (cols < length[:, None])
        grid = np.zeros((n, width), np.uint8)
        grid[fresh] = np.frombuffer(data, np.uint8, int(fresh.sum()), at)
        at += int(fresh.sum())
        # A column's byte comes from the last entry that wrote it, as long as every entry since shares it.
        source = np.maximum.accumulate(np.where(cols >= keep[:, None], np.arange(n)[:, None], 0), axis=0)
        grid = grid[source, cols]
        grid[cols >= length[:, None]] = 0
        rows.append(grid)
    return lcp.astype(np.int64), rows[0], right_len.astype(np.int64), rows[1], ids, ties, place, masks


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[int], list[int], list[int]]:
    """Merges sorted runs of (shared-prefix lengths, strings of one length) with a loser tree.

    Returns for each string in order its run, its place there, and its prefix length shared with the one
    before. A run's candidate knows the prefix it shares with the last winner: of two candidates, the one
    that shares more comes first; only of equals are the bytes beyond that prefix compared.
    """
    k = 1
    while k < len(runs):
        k *= 2
    done = len(runs)
    at = [0] * len(runs)
    # The heads of all runs share nothing with the (empty) last winner.
    head = [runs[i][1][0] if i < done and runs[i][1] else None for i in range(k)]
    common = [0] * k
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = common[a], common[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        u, v = x[p:], y[p:]
        if u == v:
            first = (a, b) if a < b else (b, a)
            common[first[1]] = p + len(u)
            return first
        differ = int.from_bytes(u, "big") ^ int.from_bytes(v, "big")
        shared_now = p + len(u) - (differ.bit_length() + 7) // 8
        if u < v:
            common[b] = shared_now
            return a, b
        common[a] = shared_now
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    out_run, out_at, out_lcp = [], [], []
    while head[winner] is not None:
        lengths, strings = runs[winner]
        i = at[winner]
        out_run.append(winner)
        out_at.append(i)
        out_lcp.append(common[winner])
        i += 1
        at[winner] = i
        if i < len(strings):
            head[winner], common[winner] = strings[i], lengths[i]
        else:
            head[winner] = None
        node = (winner + k) >> 1
        while node:
            winner, loser[node] = play(winner, loser[node])
            node >>= 1
    return out_run, out_at, out_lcp


def merged(sent, level: int):
    """Step 3: merge the runs that came to one group and find the windows that repeat across blocks.

    Below the last level the rest goes on as runs for the next one, else only what repeats is returned.
    """

    def run(group: pa.Table) -> pa.Table:
        ranges = sent.value
        part = group.column("part")[0].as_py()
        first = ranges.first(level, part) // ranges.fan
        rows = sorted(zip(group.column("kind").to_pylist(), group.column("run").to_pylist(), strict=True))
        cuts = [d for k, d in rows if k == CUT]
        read = [read_run(d) for k, d in rows if k == ANCHOR]
        left = None
        if len(read) == 1:  # a run alone repeats nothing that its blocks have not seen
            left = read[0]
        elif read:
            strings = []
            for lcp, suffix, *_ in read:
                flat = suffix.tobytes()
                strings.append((lcp.tolist(), [flat[i * LENGTH : (i + 1) * LENGTH] for i in range(len(lcp))]))
            which, at, lcp = map(np.array, merge_runs(strings))
            del strings
            place = np.cumsum([0, *(len(r[0]) for r in read)])[which] + at
            suffix, right_len, context, ids, ties, pos, masks = (np.concatenate([r[i] for r in read])[place] for i in range(1, 8))
            near = lcp >= GRAM
            some = np.flatnonzero(near | np.concatenate((near[1:], [False])))
            rank = np.empty(len(some), np.int64)
            rank[np.lexsort((pos[some], ties[some], ids[some]))] = np.arange(len(some))
            # Entries left out share less than a gram with their neighbours: the prefix shared across them is below GRAM too.
            cut = np.zeros(len(lcp), np.uint64)
            cut[some] = repeats(np.where(near, lcp, 0)[some], np.ascontiguousarray(context[some]), masks[some], rank)
            hit = cut != 0
            if hit.any():
                cuts.append(packed_cuts(ids[hit], ties[hit], pos[hit], cut[hit]))
            masks = masks & ~cut
            rest = np.flatnonzero(masks)
            left = (fewer(lcp, rest), *(x[rest] for x in (suffix, right_len, context, ids, ties, pos, masks)))
        if level < ranges.levels:
            zero = int(ranges.part(level + 1, first, np.zeros(1, np.int64))[0])
            return as_runs([(zero, CUT, d) for d in cuts] + (cut_up(ranges, level + 1, first, left) if left else []))
        a, b, c, d = np.concatenate([np.empty((4, 0), np.int64), *(np.frombuffer(x, np.int64).reshape(4, -1) for x in cuts)], axis=1)
        return pa.table({"a": a, "b": b, "c": c, "d": d})

    return run


def spans(block: Block) -> dict[int, list[tuple[int, int]]]:
    """Row -> removed runs of bytes, in order."""
    ids, ties, place, cut = block.side[CUT]
    out: dict[int, list[tuple[int, int]]] = {}
    for key in block.copy:
        for i in block.rows.get(key, ()):
            n = int(block.end[i] - block.start[i])
            if n >= LENGTH:
                out[i] = [(0, n)]
    if not len(ids):
        return out
    bits = (cut.view(np.uint64)[:, None] >> np.arange(SPAN, dtype=np.uint64)) & np.uint64(1)
    entry, offset = np.nonzero(bits)
    row = np.array([block.rows[key][0] for key in zip(ids.tolist(), ties.tolist(), strict=True)], np.int64)[entry]
    at = place[entry] - offset
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] > at[:-1] + LENGTH)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(row)])) - 1
    for i, a, b in zip(row[first].tolist(), at[first].tolist(), (at[last] + LENGTH).tolist(), strict=True):
        out.setdefault(i, []).append((a, b))
    for i in list(out):
        for twin in block.rows[(int(block.ids[i]), int(block.ties[i]))]:
            out[twin] = out[i]
    return out


def emit_result(keep: list[str], with_text: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left, right)
        cuts = spans(block)
        cols: list[list] = [[] for _ in range(5)]
        for i in range(block.n):
            a, b = int(block.start[i]), int(block.end[i])
            gone, digest, text, at = cuts.get(i, []), hashlib.sha256(), [], 0
            for x, y in [*gone, (b - a, b - a)]:
                part = block.data[a + at : a + x]
                digest.update(part)
                if with_text:  # a character that a cut parts goes with it
                    text.append(part.tobytes().decode("utf-8", "ignore"))
                at = y
            for c, v in zip(cols, (b - a, sum(y - x for x, y in gone), len(gone), digest.hexdigest(), "".join(text)), strict=True):
                c.append(v)
        made = {c: left.column(c) for c in keep} | {"n_bytes": pa.array(cols[0], pa.int64()), "n_removed": pa.array(cols[1], pa.int64()), "n_spans": pa.array(cols[2], pa.int64()), "kept_sha256": pa.array(cols[3], pa.string())}
        return pa.table(made | ({"kept_text": pa.array(cols[4], pa.string())} if with_text else {}))

    return run


def remove_repeats(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns `keep`, n_bytes, n_removed, n_spans, kept_sha256, and with_text the rest as kept_text."""
    spark = df.sparkSession
    ship(spark)
    blocks = n_blocks(df, "text", block_bytes)
    deal = max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(text.cast("binary"))
    number = F.pmod(F.xxhash64("__id", "__tie"), F.lit(blocks)).cast("int")
    keyed = lambda cols: df.select(*cols, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__id"), F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("__tie"))
    own = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)]
    docs = keyed([*own, text.alias("__text")]).withColumn("block", number).repartition(deal, "block")
    names = keyed([digest.alias("__digest")])
    # Only texts that have copies; stored, so that Spark may split a large group's rows over tasks.
    firsts = stored(names.groupBy("__digest").agg(F.min("__id").alias("first"), F.max("__id").alias("last")).where("first < last").select("__digest", "first"))
    zero = F.lit(0).cast("long")
    copies = join_sized(names, firsts, "__digest", "inner").where("__id > first").select(number.alias("block"), F.lit(COPY).alias("kind"), F.col("__id").alias("a"), F.col("__tie").alias("b"), zero.alias("c"), zero.alias("d"))
    meet = lambda side, f, schema: docs.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(f, schema)
    n_ranges = max(4 * FAN, -(-blocks // RANGE_BLOCKS))
    rate = max(1, blocks * block_bytes // (REPEATED_EVERY * SAMPLED * n_ranges))
    hashes = meet(copies, emit_anchors(rate), "key long, block int, n int, gram binary").repartition(deal, "key")
    twice = F.sum("n").over(Window.partitionBy("key"))
    known = stored(hashes.withColumn("all", twice).where("all > 1").select("key", "block", "gram"))
    borders = known.where("gram is not null").groupBy("key").agg(F.min("gram").alias("gram"))
    few = max(1, borders.count() // (2 * SAMPLED * n_ranges))
    # At most a few dozen for each range come to the driver; of them, in order, each so-manieth is a border.
    grams = sorted(bytes(r[0]) for r in borders.where(F.pmod(F.xxhash64("key"), F.lit(few)) == 0).select("gram").collect())
    ranges = Ranges([grams[i * len(grams) // n_ranges] for i in range(1, n_ranges)] if grams else [], blocks, FAN)
    sent = spark.sparkContext.broadcast(ranges)
    anchors_ = known.select("block", F.lit(ANCHOR).alias("kind"), F.col("key").alias("a"), zero.alias("b"), zero.alias("c"), zero.alias("d"))
    runs = meet(copies.unionByName(anchors_), emit_runs(sent), RUNS)
    for level in range(1, ranges.levels):
        runs = runs.repartition(deal, "part").groupBy("part").applyInArrow(merged(sent, level), RUNS)
    found = runs.repartition(deal, "part").groupBy("part").applyInArrow(merged(sent, ranges.levels), "a long, b long, c long, d long")
    cuts = found.select(F.pmod(F.xxhash64("a", "b"), F.lit(blocks)).cast("int").alias("block"), F.lit(CUT).alias("kind"), "a", "b", "c", "d")
    kept = [f"__keep_{i}" for i in range(len(keep))]
    fields = [T.StructField(c, df.schema[k].dataType) for c, k in zip(kept, keep, strict=True)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]
    schema = T.StructType(fields + [T.StructField("kept_text", T.StringType())] * with_text)
    return meet(copies.unionByName(cuts), emit_result(kept, with_text), schema).withColumnsRenamed(dict(zip(kept, keep, strict=True)))


def cleaned(df: DataFrame) -> DataFrame:
    """df with its repeated passages cut out of text (null becomes empty) and n_chars, if there, set anew."""
    rest = remove_repeats(df, keep=tuple(c for c in df.columns if c not in ("text", "n_chars")), with_text=True)
    made = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return rest.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns])


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


#: The same in SQL: every window of every text by its digest, the later ones put together to runs.
ORACLE = f"""
with d as (select doc_id, encode(coalesce(text, '')) as b, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, i, md5(substr(h, 2 * i + 1, {2 * LENGTH})) as m from (select doc_id, h, unnest(range(0, octet_length(b) - {LENGTH - 1})) as i from d)),
r as (select doc_id, i from w qualify row_number() over (partition by m order by doc_id, i) > 1),
n as (select *, case when i <= lag(i) over (partition by doc_id order by i) + {LENGTH} then 0 else 1 end as new from r),
g as (select *, sum(new) over (partition by doc_id order by i) as run from n),
s as (select doc_id, run, min(i) as a, max(i) + {LENGTH} as z from g group by 1, 2),
p as (select s.*, h, coalesce(lag(z) over (partition by doc_id order by a), 0) as done from s join d using (doc_id)),
k as (select doc_id, string_agg(substr(h, 2 * done + 1, 2 * (a - done)), '' order by a) || substr(any_value(h), 2 * max(z) + 1) as rest, sum(z - a) as n_removed, count(*) as n_spans from p group by 1)
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(case when rest is null then b else unhex(rest) end) as kept_sha256 from d left join k using (doc_id)
"""
