"""Substring deduplication by MinHash banding over paragraphs.

Three kinds of units of a text are compared, all as lower-cased (A-Z) words:

* ``LINE``: a line of at least ``SHINGLE`` words, the paragraph as written;
* ``BLOCK``: several lines between blank lines, their words joined: a paragraph broken into lines;
* ``PIECE``: a run of words between two content-defined cuts (the local minima of a hash of word
  pairs). A cut depends on ``REACH`` words on either side only, so a passage that repeats inside
  other paragraphs is cut alike wherever it stands. Runs at the ends of a text are not compared.

Every unit has a MinHash signature over its five-word shingles. Lines and blocks use ``LINE_BANDS`` bands of two
values: at a similarity of 0.8 a pair is missed with probability (1 - 0.64) ** 7 < 0.001. Pieces hold
few shingles; they use two bands of one value (0.2 ** 2 = 0.04 at 0.8, none for equal pieces).
Equal units are one content. Different contents that collide in a band are verified by the exact
Jaccard similarity of their shingle sets, and a band bucket yields a spanning forest of its links.
Of each component the first unit (by doc_id, then place) stays and the others are to be removed, but
for units that overlap it in its own text: a line and the block around it are no copies of each other.
Of a unit that is similar only what lies between its first and last shingle of the kept unit goes. A
removed span takes in what it shares with the kept unit's text on both sides: it grows word by word over
equal words, and over differences as long as the shingles of the whole span stay similar by 0.8 (aligned
in order). Of its outer lines a span takes ``SHINGLE`` words at least, or the whole line. It never overlaps the kept unit, so of exact copies every shingle stays somewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import Scratch, column_bytes, count_groups, mix64, run_starts, stream64, text_key, word_hashes, word_spans
from landfall.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
LINE, PIECE, BLOCK = 0, 1, 2
PIECE_WORDS = 7
REACH = 6
LINE_BANDS, LINE_ROWS = 7, 2
PIECE_BANDS = 2
#: Text handled at once in a task, and contents remembered there so that equal ones give their rows once.
BLOCK_BYTES = 1 << 21
SEEN_CONTENTS = 1 << 20
#: Contents of a band bucket compared at once, and bytes of their shingle sets; a larger bucket is keyed
#: again on prefix shingles, and one that is still larger is compared block against block.
BUCKET_ROWS = 1 << 14
BUCKET_BYTES = 64 << 20
#: Contents of buckets that are compared all at once, pair by pair, and bytes of shingle sets that wait for it;
#: buckets of more contents than ``INDEXED`` are searched by an index of their rarest shingles.
FEW = 8
SETS_AT_ONCE = 4 << 20
INDEXED = 48
#: Contents of more shingles are not keyed on prefixes, whose number grows with theirs.
LONG_SET = 512
#: Band keys with so many contents in a sample of about so many rows are dealt out by content; at most so many keys.
SAMPLE_ROWS = 10_000
HOT_CONTENTS = 32
MOST_HOT = 4096
#: Text whose band rows make a part that is searched at once, band rows that a task gathers before it deals them, and bytes of each.
PART_BYTES = 1 << 23
HELD_ROWS = 1 << 20
ROW_BYTES = 20
#: Words compared at first on either side of a repeat, and words that may be skipped in a text at a difference.
CONTEXT = 24
SKIP = 3

_SEED = stream64(64, 3)
_STEP = np.uint64(0x9E3779B97F4A7C55)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values that follow each other."""
    k, m = 1, x
    while 2 * k <= width:
        m, k = np.minimum(m[:-k], m[k:]), 2 * k
    return np.minimum(m[:x.size - width + 1], m[width - k:])


def _cuts(pair: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Words that start a piece: their pair hash is the smallest within ``REACH`` words on either
    side (the first of equal ones), all of the same text."""
    n = pair.size
    if n <= 2 * REACH:
        return np.empty(0, dtype=np.int64)
    least, own = _least(pair, REACH), pair[REACH:n - REACH]
    at = np.flatnonzero((own < least[:own.size]) & (own <= least[REACH + 1:])) + REACH
    at = at[at + REACH + 1 < n]
    return at[text_of[at - REACH] == text_of[at + REACH + 1]]


_STEP_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _step_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to ``n`` of ``_STEP`` and of its inverse modulo 2**64, grown on demand."""
    if _STEP_POWERS[0].size <= n:
        for k, x in enumerate((int(_STEP), pow(int(_STEP), -1, 1 << 64))):
            _STEP_POWERS[k] = np.cumprod(np.append(np.uint64(1), np.full(max(n, 2 * _STEP_POWERS[k].size), x, dtype=np.uint64)))
    return _STEP_POWERS[0][:n + 1], _STEP_POWERS[1][:n + 1]


class Units:
    """The units of a block of texts: ``text`` (index), ``kind``, ``start``, ``size`` (bytes in its
    text), ``word`` (words of its text before it), ``words``, ``content`` and, of each, its place among
    the block's words. Units of a kind follow each other and don't overlap."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.empty(0, dtype=np.int64)
        start, end = word_spans(data)
        self.hash = word_hashes(data, start, end)
        n = start.size
        text_first = np.searchsorted(start, begin)
        self.text_of = text_of = np.repeat(np.arange(begin.size), np.diff(text_first, append=n))
        line_of = np.cumsum(np.bincount(np.searchsorted(start, np.flatnonzero(data == 10)), minlength=n + 1)[:n])
        first = run_starts(line_of)
        last = np.append(first[1:], n) if n else first
        long = last - first >= SHINGLE
        with np.errstate(over="ignore"):
            follow = np.append(self.hash[1:], np.uint64(0)) if n else self.hash
            cut = _cuts(mix64(self.hash + _STEP * follow), text_of)
        same = text_of[cut[1:]] == text_of[cut[:-1]]
        p_first, p_last = cut[:-1][same], cut[1:][same]
        enough = p_last - p_first >= PIECE_WORDS
        # Blocks: a blank line or a text's end stands between them.
        apart = np.ones(n, dtype=bool)
        apart[1:] = (line_of[1:] - line_of[:-1] > 1) | (text_of[1:] != text_of[:-1])
        b_first = np.flatnonzero(apart)
        b_last = np.append(b_first[1:], n) if n else b_first
        several = (line_of[b_last - 1] > line_of[b_first]) & (b_last - b_first >= SHINGLE)
        self.first = np.concatenate([first[long], b_first[several], p_first[enough]])
        self.last = np.concatenate([last[long], b_last[several], p_last[enough]])
        self.kind = np.repeat(np.array([LINE, BLOCK, PIECE], dtype=np.int8), [int(long.sum()), int(several.sum()), int(enough.sum())])
        self.words = self.last - self.first
        self.text = text_of[self.first]
        self.word = self.first - text_first[self.text]
        self.start = start[self.first] - begin[self.text]
        self.size = end[self.last - 1] - start[self.first]
        # A content's hash: polynomial over its word hashes (a difference of two sums), and their number.
        with np.errstate(over="ignore"):
            power, inverse = _step_powers(n)
            total = np.append(np.uint64(0), np.cumsum(self.hash * power[1:]))
            total = (total[self.last] - total[self.first]) * inverse[self.first]
            self.content = mix64(total + self.words.astype(np.uint64)).view(np.int64)

    def shingles(self) -> np.ndarray:
        """64-bit hash of the shingle at each word of the block; a unit has those from its first word on, ``SHINGLE`` - 1 fewer than words."""
        n = max(0, self.hash.size - (SHINGLE - 1))
        with np.errstate(over="ignore"):
            s = np.zeros(n, dtype=np.uint64)
            for k in range(SHINGLE):
                s = (s + self.hash[k:k + n]) * _STEP
            return mix64(s)

    def _distinct(self, s: np.ndarray) -> np.ndarray:
        """How many different shingles each unit has: those that don't stand in it once more before."""
        n = self.words - (SHINGLE - 1)
        with np.errstate(over="ignore"):
            own = mix64(s + self.text_of[:s.size].astype(np.uint64) * _STEP)
        every = np.sort(own)
        again = every[1:][every[1:] == every[:-1]]
        if not again.size:
            return n
        low = np.uint64((1 << 20) - 1)
        may = np.zeros(1 << 20, dtype=bool)
        may[(again & low).astype(np.int64)] = True
        few = np.flatnonzero(may[(own & low).astype(np.int64)])
        order = few[np.argsort(own[few], kind="stable")]
        follows = own[order[1:]] == own[order[:-1]]
        place, before = order[1:][follows], order[:-1][follows]
        for kind in (LINE, BLOCK, PIECE):
            units = np.flatnonzero(self.kind == kind)
            if units.size:
                at = units[np.maximum(np.searchsorted(self.first[units], place, side="right") - 1, 0)]
                inside = (before >= self.first[at]) & (place <= self.last[at] - SHINGLE)
                n = n - np.bincount(at[inside], minlength=n.size)
        return n

    def bands(self):
        """Rows (key, unit): the band keys of every unit; and the different shingles of each unit."""
        if not self.first.size:
            return (np.empty(0, dtype=np.int64),) * 3
        s, n = self.shingles(), self.words - (SHINGLE - 1)
        distinct = self._distinct(s)
        # Fewer than four shingles are similar to another set only if it is the same set: words of a period up to three.
        at = self.first[:, None] + np.arange(4)
        h = self.hash[at]
        can = (n >= 4) | (h[:, :1] == h[:, 1:]).any(axis=1)

        def edges(units):
            """Where the units' shingles begin and end."""
            at = np.stack([self.first[units], self.last[units] - (SHINGLE - 1)], axis=1).ravel()
            return at[:-1] if at.size and at[-1] == s.size else at

        keys, units = [], []
        # A block meets lines too: a paragraph may be wrapped in one text only.
        for kind, parts, bands, rows in ((LINE, (LINE, BLOCK), LINE_BANDS, LINE_ROWS), (PIECE, (PIECE,), PIECE_BANDS, 1)):
            own = [u for k in parts if (u := np.flatnonzero(self.kind == k)).size]
            if not own:
                continue
            unit, own = np.concatenate(own), [edges(u) for u in own]
            for b in range(bands):
                key = np.zeros(unit.size, dtype=np.uint64)
                with np.errstate(over="ignore"):
                    for r in range(rows):
                        x = s * (_SEED[20 * kind + b * rows + r] | np.uint64(1))
                        key = (key + np.concatenate([np.minimum.reduceat(x, e)[::2] for e in own])) * _STEP
                    keys.append(mix64(key + _SEED[40 + 10 * kind + b]).view(np.int64)[can[unit]])
                units.append(unit[can[unit]])
        return np.concatenate(keys), np.concatenate(units), distinct


def _plain(c: pa.Array) -> list:
    """``c.to_pylist()``, with rows of lists and structs taken from whole columns."""
    if c.null_count:
        return c.to_pylist()
    if pa.types.is_list(c.type):
        flat, edge = _plain(c.flatten()), [0, *np.cumsum(c.value_lengths().to_numpy()).tolist()]
        return [flat[x:y] for x, y in zip(edge, edge[1:])]
    if pa.types.is_struct(c.type):
        names = [f.name for f in c.type]
        return [dict(zip(names, x)) for x in zip(*map(_plain, c.flatten()))]
    if pa.types.is_integer(c.type) or pa.types.is_boolean(c.type):
        return c.to_numpy(zero_copy_only=False).tolist()
    return c.to_pylist()


def _blocks(batches):
    """(doc_id, text_key, texts) blocks of bounded size; a longer text is a block of its own."""
    ids, keys, texts, size = [], [], [], 0
    for b in batches:
        for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), column_bytes(b, "text")):
            if t:
                if texts and size + len(t) > BLOCK_BYTES:
                    yield ids, keys, texts
                    ids, keys, texts, size = [], [], [], 0
                ids.append(i)
                keys.append(k)
                texts.append(t)
                size += len(t)
    if texts:
        yield ids, keys, texts


class _Seen:
    """Contents that a task has met, forgotten from time to time so that it stays bounded."""

    def __init__(self, most: int = SEEN_CONTENTS):
        self.known, self.most = np.empty(0, dtype=np.int64), most

    def new(self, content: np.ndarray) -> np.ndarray:
        """Places of the contents that were not met before, each once."""
        every, at = np.unique(content, return_index=True)
        if self.known.size:
            where = np.minimum(np.searchsorted(self.known, every), self.known.size - 1)
            fresh = self.known[where] != every
            every, at = every[fresh], at[fresh]
        self.known = np.sort(np.concatenate([self.known, every]), kind="stable") if self.known.size + every.size <= self.most else every
        return at


def _packed(rows: list, parts: int, known: np.ndarray | None = None) -> tuple[pa.Array, pa.Array]:
    """(part, rows): band rows (key, content, distinct) dealt by key to ``parts`` parts, those of ``known`` keys by
    content too; ``rows`` holds all keys, then all contents and all numbers of shingles of the rows for one part."""
    key, content, distinct = (np.concatenate(x) for x in zip(*rows))
    of = key.view(np.uint64)
    if known is not None:
        with np.errstate(over="ignore"):
            of = np.where(np.isin(key, known), of + _STEP * content.view(np.uint64), of)
    part = (mix64(of ^ _SEED[62]) % np.uint64(parts)).astype(np.int32 if parts > 1 << 16 else np.uint16)
    order = np.argsort(part, kind="stable")
    part, key, content, distinct = part[order], key[order], content[order], distinct[order].astype(np.int32)
    first = run_starts(part)
    cut = zip(first.tolist(), [*first[1:].tolist(), part.size])
    return pa.array(part[first].astype(np.int32)), pa.array([key[x:y].tobytes() + content[x:y].tobytes() + distinct[x:y].tobytes() for x, y in cut], pa.binary())


def _unpacked(rows: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(rows) // ROW_BYTES
    return np.frombuffer(rows, np.int64, n), np.frombuffer(rows, np.int64, n, 8 * n), np.frombuffer(rows, np.int32, n, 16 * n)


_UNITS = "doc_id long, text_key long, kind byte, start int, size int, word int, words int, content long"


def _find_units(parts: int):
    names, kinds = zip(*(c.split() for c in _UNITS.split(", ")))
    kinds = [{"long": pa.int64(), "byte": pa.int8(), "int": pa.int32()}[k] for k in kinds]

    def dealt(rows):
        part, packed = _packed(rows, parts)
        return pa.RecordBatch.from_arrays([*(pa.nulls(len(part), k) for k in kinds), part, packed], [*names, "part", "rows"])

    def run(batches):
        seen = _Seen()
        rows, held = [], 0
        for ids, keys, texts in _blocks(batches):
            u = Units(texts)
            key, unit, distinct = u.bands()
            first = np.zeros(u.content.size, dtype=bool)
            first[seen.new(u.content)] = True
            own = first[unit]
            key, unit = key[own], unit[own]
            rows.append((key, u.content[unit], distinct[unit]))
            held += key.size
            at = pa.array(u.text)
            columns = [pa.array(ids, pa.int64()).take(at), pa.array(keys, pa.int64()).take(at), *(pa.array(x) for x in (u.kind, *(c.astype(np.int32) for c in (u.start, u.size, u.word, u.words)), u.content))]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary())], [*names, "part", "rows"])
            if held >= HELD_ROWS:
                yield dealt(rows)
                rows, held = [], 0
        if held:
            yield dealt(rows)

    return run


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("text_key"), F.col("text").cast("binary").alias("text"))


def find_units(docs: DataFrame) -> DataFrame:
    """Every unit of every whole text (``part`` is NULL), and the band keys of the contents, with these and the numbers of their
    different shingles, once for each content that a task meets: they go by key to parts for about ``PART_BYTES`` of text, and the
    rows of one part leave a task together (``part, rows``). NULL and empty texts have no units."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = count_groups(size, PART_BYTES, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return _source(docs).mapInArrow(_find_units(parts), f"{_UNITS}, part int, rows binary")


def _sampled(share: float):
    """The packed rows of about a ``share`` of the contents."""

    def run(batches):
        for b in batches:
            out = []
            for x in b.column(1).to_pylist():
                rows = _unpacked(x)
                own = mix64(rows[1].view(np.uint64)) >> np.uint64(34) < np.uint64(int(share * (1 << 30)))
                out.append(b"".join(r[own].tobytes() for r in rows))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["part", "rows"])

    return run


def _counted(contents: int):
    """(key, n) of the keys with at least so many different contents."""

    def run(batches):
        for rows in _parts(batches):
            key, content, _ = _different(*(np.concatenate(x) for x in zip(*map(_unpacked, rows))))
            first = run_starts(key)
            n = np.diff(first, append=key.size)
            yield pa.RecordBatch.from_arrays([pa.array(key[first][n >= contents]), pa.array(n[n >= contents])], ["key", "n"])

    return run


def hot_keys(units: DataFrame, n_docs: int, sample_rows: int = SAMPLE_ROWS, contents: int = HOT_CONTENTS) -> list[int]:
    """Band keys that hold at least ``contents`` different contents in a sample chosen by hash, as many as ``sample_rows`` texts
    have. They only decide how rows are dealt to tasks; every key collides whether or not it is found here."""
    share = sample_rows / max(1, n_docs)
    bands = units.filter("part IS NOT NULL").select("part", "rows")
    if share < 1:
        bands = bands.mapInArrow(_sampled(share), "part int, rows binary")
    seen = bands.repartition("part").sortWithinPartitions("part").mapInArrow(_counted(contents), "key long, n long")
    return [r["key"] for r in seen.orderBy(F.desc("n"), "key").limit(MOST_HOT).collect()]


def _fits(key: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Rows sorted by key and size that are not too small or too large for all others of their key: sets
    of a similarity of 0.8 or more differ in size by a fifth at most."""
    near = (key[1:] == key[:-1]) & (distinct[:-1].astype(np.int64) * 5 >= distinct[1:].astype(np.int64) * 4)
    return np.append(near, False) | np.append(False, near)


def _buckets(hot: list[int], bucket_rows: int, fitting: bool):
    """(key, content, distinct, hot, large) of the rows (key, content, distinct), sorted by key, whose key
    holds several contents; with ``fitting`` without those that are too small or too large for all others
    of their key. The rows of a key in ``hot`` and of large keys stay, and may come twice if the key has
    more than ``bucket_rows`` contents here; all others come once."""
    known = np.array(sorted(hot), dtype=np.int64)

    def out(key, content, distinct, is_hot, large):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, content, distinct, is_hot, large)], ["key", "content", "distinct", "hot", "large"])

    def run(batches):
        held = [np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)]
        large = None  # the key whose rows went out as large before its end was seen

        def once(key, content, distinct):
            order = np.lexsort((content, distinct, key))
            order = order[run_starts(key[order], content[order])]
            return key[order], content[order], distinct[order]

        def whole(key, content, distinct):
            """Of keys that are seen to their end."""
            first = run_starts(key)
            n = np.diff(first, append=key.size)
            n = np.repeat(n, n)
            is_hot = np.isin(key, known)
            over = ~is_hot & ((n > bucket_rows) | (key == large if large is not None else False))
            wanted = is_hot | over | (n > 1)
            if fitting:
                wanted &= is_hot | over | _fits(key, distinct)
            return out(key[wanted], content[wanted], distinct[wanted], is_hot[wanted], over[wanted])

        for b in batches:
            held = [np.concatenate([x, b.column(k).to_numpy(zero_copy_only=False)]) for k, x in enumerate(held)]
            edge = int(np.searchsorted(held[0], held[0][-1:])[0]) if held[0].size else 0
            if edge:
                yield whole(*once(*(x[:edge] for x in held)))
                held, large = [x[edge:] for x in held], None
            if held[0].size > bucket_rows:
                held = list(once(*held))
                if held[0].size > bucket_rows or large is not None:
                    large, is_hot = held[0][0], np.isin(held[0], known)
                    yield out(*held, is_hot, ~is_hot)
                    held = [x[:0] for x in held]
        if held[0].size:
            yield whole(*once(*held))

    return run


def _different(key: np.ndarray, content: np.ndarray, distinct: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different rows, sorted by key and content."""
    order = np.lexsort((content, key))
    order = order[run_starts(key[order], content[order])]
    return key[order], content[order], distinct[order]


def _parts(batches):
    """The packed rows of each part, of rows sorted by part."""
    part, held = None, []
    for b in batches:
        for p, x in zip(_plain(b.column(0)), b.column(1).to_pylist()):
            if p != part and held:
                yield held
                held = []
            part = p
            held.append(x)
    if held:
        yield held


def _dealt_anew(hot: list[int]):
    """Packed rows with those of hot keys dealt by content, in parts of their own."""
    known = np.array(sorted(hot), dtype=np.int64)

    def run(batches):
        for b in batches:
            parts, out, moved = _plain(b.column(0)), [], []
            for x in b.column(1).to_pylist():
                rows = _unpacked(x)
                is_hot = np.isin(rows[0], known)
                if is_hot.any():
                    moved.append([r[is_hot] for r in rows])
                    x = b"".join(r[~is_hot].tobytes() for r in rows)
                out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(out, pa.binary())], ["part", "rows"])
            if moved:
                part, packed = _packed(moved, 1 << 10, known)
                yield pa.RecordBatch.from_arrays([pc.subtract(-1, part).cast(pa.int32()), packed], ["part", "rows"])

    return run


def _part_buckets(hot: list[int], bucket_rows: int, fitting: bool):
    """``_buckets`` of the packed rows of each part; of a part with very many rows those of hot keys and of keys with
    more than ``bucket_rows`` contents go out before its end."""
    known = np.array(sorted(hot), dtype=np.int64)
    buckets = _buckets(hot, bucket_rows, fitting)

    def early(key, content, distinct):
        is_hot = np.isin(key, known)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, content, distinct, is_hot, ~is_hot)], ["key", "content", "distinct", "hot", "large"])

    def run(batches):
        part, rows, held, most, large = None, [], 0, 8 * HELD_ROWS, known[:0]

        def close():
            key, content, distinct = (np.concatenate(x) for x in zip(*rows))
            order = np.argsort(key)
            key, content, distinct = key[order], content[order], distinct[order]
            met = np.append(key[1:] == key[:-1], False)
            met[1:] |= met[:-1]
            gone = np.isin(key, large)
            if gone.any():
                yield early(key[gone], content[gone], distinct[gone])
            met = (met | np.isin(key, known)) & ~gone
            yield from buckets([pa.RecordBatch.from_arrays([pa.array(x[met]) for x in (key, content, distinct)], ["key", "content", "distinct"])])

        for b in batches:
            for p, x in zip(_plain(b.column(0)), b.column(1).to_pylist()):
                if p != part:
                    if held:
                        yield from close()
                    part, rows, held, most, large = p, [], 0, 8 * HELD_ROWS, known[:0]
                rows.append(_unpacked(x))
                held += rows[-1][0].size
                if held >= most:
                    key, content, distinct = _different(*(np.concatenate(x) for x in zip(*rows)))
                    first = run_starts(key)
                    n = np.diff(first, append=key.size)
                    is_hot = np.isin(key, known)
                    go = np.repeat(n > bucket_rows, n) | is_hot | np.isin(key, large)
                    if go.any():
                        yield early(key[go], content[go], distinct[go])
                    large = np.union1d(large, key[go & ~is_hot])
                    rows = [(key[~go], content[~go], distinct[~go])]
                    held = rows[0][0].size
                    most = max(most, 2 * held)
        if held:
            yield from close()

    return run


def colliding(units: DataFrame, hot: list[int], bucket_rows: int = BUCKET_ROWS, fitting: bool = False) -> DataFrame:
    """``(key, content, distinct, hot, large)`` of the bands that hold different contents; ``large`` marks
    keys of more than ``bucket_rows`` contents. The rows of a key in ``hot``, which is known to collide, are
    dealt by content, so no task gets them all; they are not counted here. With ``fitting``, contents too
    small or too large for all others of their bucket are left out; hot and large buckets stay."""
    bands = units.filter("part IS NOT NULL").select("part", "rows")
    if hot:
        bands = bands.mapInArrow(_dealt_anew(hot), "part int, rows binary")
    return bands.repartition("part").sortWithinPartitions("part").mapInArrow(
        _part_buckets(hot, bucket_rows, fitting), "key long, content long, distinct int, hot boolean, large boolean")


def count_hot(collided: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``colliding`` with ``large`` told for hot keys too (of which there are ``MOST_HOT`` at most)."""
    over = collided.filter("hot").groupBy("key").count().filter(F.col("count") > bucket_rows)
    keys = [r["key"] for r in over.collect()]
    return collided.withColumn("large", F.col("large") | F.col("key").isin(keys)) if keys else collided


def sets_of(units: list[bytes]) -> list[bytes]:
    """The sorted distinct shingles of units of at least ``SHINGLE`` words each, as bytes."""
    data = np.frombuffer(b"\n".join(units).lower(), dtype=np.uint8)
    begin = np.cumsum([0] + [len(u) + 1 for u in units[:-1]])
    start, end = word_spans(data)
    h = word_hashes(data, start, end)
    first = np.searchsorted(start, begin)
    n = np.diff(first, append=start.size) - (SHINGLE - 1)
    unit = np.repeat(np.arange(n.size), n)
    at = np.arange(unit.size) + (SHINGLE - 1) * unit
    with np.errstate(over="ignore"):
        s = np.zeros(at.size, dtype=np.uint64)
        for k in range(SHINGLE):
            s = (s + h[at + k]) * _STEP
    s = mix64(s)
    order = np.lexsort((s, unit))
    unit, s = unit[order], s[order]
    own = run_starts(unit, s)
    flat, edge = s[own].tobytes(), 8 * np.searchsorted(unit[own], np.arange(n.size + 1))
    return [flat[x:y] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _shingle_sets(batches):
    """(content, shingles) of the wanted units; ``places`` has their (start, size, content)."""
    seen = set()  # a text that stands in several rows has its sets once a task
    contents, units, held = [], [], 0

    def flush():
        made = pa.RecordBatch.from_arrays([pa.array(contents, pa.int64()), pa.array(sets_of(units), pa.binary())], ["content", "shingles"])
        contents.clear()
        units.clear()
        return made

    for b in batches:
        for text, places in zip(_plain(b.column(0)), _plain(b.column(1))):
            for p in places:
                if p["content"] in seen:
                    continue
                if len(seen) >= SEEN_CONTENTS:
                    seen.clear()
                seen.add(p["content"])
                contents.append(p["content"])
                units.append(text[p["start"]:p["start"] + p["size"]])
                held += p["size"]
                if held >= BLOCK_BYTES:
                    yield flush()
                    held = 0
    if units:
        yield flush()


def shingle_sets(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The sorted distinct shingles of one unit of each content in ``places``."""
    wanted = places.groupBy(F.col("doc_id").alias("_lf_id"), F.col("text_key").alias("_lf_key")).agg(
        F.collect_list(F.struct("start", "size", "content")).alias("places"))
    d = _source(docs)
    return (d.join(wanted, d["doc_id"].eqNullSafe(F.col("_lf_id")) & (d["text_key"] == F.col("_lf_key")))
            .select("text", "places").mapInArrow(_shingle_sets, "content long, shingles binary"))


def _prefix_size(size: np.ndarray) -> np.ndarray:
    """Two sets of similarity 0.8 share one of their first so many shingles in any order common to both."""
    return size - np.ceil(SIMILARITY * size - 1e-9).astype(np.int64) + 1


class _Rarest:
    """Which sets of a bucket hold which of their rarest shingles: sets that are similar share one of
    them. ``flat`` has the sets one after the other, each of ``size`` shingles from ``offset`` on."""

    def __init__(self, flat: np.ndarray, offset: np.ndarray, size: np.ndarray):
        _, name, count = np.unique(flat, return_inverse=True, return_counts=True)
        place = np.empty(count.size, dtype=np.int64)  # of a shingle when all are sorted by the sets that hold it
        place[np.argsort(count, kind="stable")] = np.arange(count.size)
        held = place[name] + (np.repeat(np.arange(size.size), size) << 32)
        held.sort()
        first = np.arange(flat.size) - np.repeat(offset, size) < np.repeat(_prefix_size(size), size)
        held = held[first & (held & 0xFFFFFFFF >= np.count_nonzero(count == 1))]
        self.name, holder = held & 0xFFFFFFFF, held >> 32
        self.edge = np.searchsorted(holder, np.arange(size.size + 1))
        by_name = np.argsort(self.name, kind="stable")
        self.holder, self.start = holder[by_name], np.searchsorted(self.name[by_name], np.arange(count.size + 1))

    def sharing(self, x: int) -> np.ndarray:
        """The sets that share a rare shingle with set ``x``, itself among them, some more than once."""
        names = self.name[self.edge[x]:self.edge[x + 1]].tolist()
        found = [self.holder[self.start[k]:self.start[k + 1]] for k in names]
        return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def similar_forest(content: np.ndarray, sets: list[np.ndarray], indexed: int = INDEXED) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs whose Jaccard similarity is ``SIMILARITY`` or more. With more than
    ``indexed`` sets only those that share a rare shingle are compared, which loses no pair."""
    size = np.array([x.size for x in sets])
    order = np.argsort(size, kind="stable")
    content, size, sets = content[order], size[order], [sets[i] for i in order]
    flat, offset = np.concatenate(sets), np.cumsum(size) - size
    rarest = _Rarest(flat, offset, size) if size.size > indexed else None
    left, us, vs = np.ones(size.size, dtype=bool), [], []
    for seed in range(size.size):
        if not left[seed]:
            continue
        left[seed] = False
        queue = [seed]
        while queue:
            x = queue.pop()
            lo, hi = np.searchsorted(size, [int(np.ceil(SIMILARITY * size[x] - 1e-9)), int(size[x] / SIMILARITY + 1e-9) + 1])
            if rarest is not None:
                other = rarest.sharing(x)
                other = np.unique(other[left[other] & (other >= lo) & (other < hi)])
                if not other.size:
                    continue
                n = size[other]
                begin = np.cumsum(n) - n
                part = flat[np.arange(int(n.sum())) + np.repeat(offset[other] - begin, n)]
            else:
                if lo >= hi or not left[lo:hi].any():
                    continue
                other, n = np.arange(lo, hi), size[lo:hi]
                begin = offset[lo:hi] - offset[lo]
                part = flat[offset[lo]:offset[hi - 1] + size[hi - 1]]
            at = np.minimum(np.searchsorted(sets[x], part), sets[x].size - 1)
            both = np.add.reduceat((sets[x][at] == part).astype(np.int64), begin)
            near = other[left[other] & (both >= SIMILARITY * (size[x] + n - both) - 1e-9)]
            left[near] = False
            us += [int(content[x])] * near.size
            vs += content[near].tolist()
            queue += near.tolist()
    return us, vs


def similar_pairs(contents: list[int], sets: list[bytes], rows: list[int]) -> tuple[list[int], list[int]]:
    """The pairs whose Jaccard similarity is ``SIMILARITY`` or more of many buckets of few contents, which
    stand one after the other, ``rows`` of each."""
    rows, content = np.array(rows), np.array(contents, dtype=np.int64)
    flat = np.frombuffer(b"".join(sets), dtype=np.uint64)
    size = np.array([len(s) for s in sets]) >> 3
    offset = np.cumsum(size) - size
    # The pairs of a bucket: each content with those that follow it.
    after = np.repeat(np.cumsum(rows), rows) - np.arange(content.size) - 1
    a = np.repeat(np.arange(content.size), after)
    b = a + 1 + np.arange(a.size) - np.repeat(np.cumsum(after) - after, after)
    a, b = np.where(size[a] <= size[b], a, b), np.where(size[a] <= size[b], b, a)
    fits = size[a] >= SIMILARITY * size[b] - 1e-9
    a, b = a[fits], b[fits]
    if not a.size:
        return [], []
    # Sets are sorted, so (set, shingle) is sorted too where shingles are numbered in their order.
    names, name = np.unique(flat, return_inverse=True)
    held = np.repeat(np.arange(size.size), size) * names.size + name
    us, vs = [], []
    many = np.cumsum(size[a])
    edges = np.unique(np.append(np.searchsorted(many, np.arange(0, int(many[-1]), SETS_AT_ONCE >> 2)), a.size))
    for x, y in zip(edges[:-1], edges[1:]):  # in parts, for bounded memory
        n = size[a[x:y]]
        begin = np.cumsum(n) - n
        part = name[np.arange(int(n.sum())) + np.repeat(offset[a[x:y]] - begin, n)] + np.repeat(b[x:y] * names.size, n)
        found = held[np.minimum(np.searchsorted(held, part), held.size - 1)] == part
        both = np.add.reduceat(found.astype(np.int64), begin)
        near = both >= SIMILARITY * (n + size[b[x:y]] - both) - 1e-9
        us += content[a[x:y][near]].tolist()
        vs += content[b[x:y][near]].tolist()
    return us, vs


def similar_pair(contents: list[int], sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """``similar_forest`` of two contents."""
    return similar_pairs(contents, [s.tobytes() for s in sets], [2])


def _verify(rows: int | None, size: int = BUCKET_BYTES):
    """Edges (kind 0) of the buckets in rows sorted by key; with ``rows``, those of a bucket with more
    contents or over ``size`` bytes of shingles come back as (kind 1) to be keyed again."""
    names = ["kind", "u", "v", "shingles"]

    def out(kind, u, v, shingles):
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(u), pa.int8()), pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(shingles, pa.binary())], names)

    def run(batches):
        key, contents, sets, held, over = None, [], [], 0, False
        few = ([], [], [])  # contents, sets and rows of buckets of few contents, compared together
        waiting = 0

        def close():
            nonlocal waiting
            if over:
                yield out(1, [key] * len(contents), contents, sets)
            elif 1 < len(contents) <= FEW:
                few[0].extend(contents)
                few[1].extend(sets)
                few[2].append(len(contents))
                waiting += held
                if waiting >= SETS_AT_ONCE:
                    yield edges()
            elif len(contents) > 1:
                u, v = similar_forest(np.array(contents, dtype=np.int64), [np.frombuffer(s, dtype=np.uint64) for s in sets])
                if u:
                    yield out(0, u, v, [None] * len(u))

        def edges():
            nonlocal waiting
            u, v = similar_pairs(*few)
            for x in few:
                x.clear()
            waiting = 0
            return out(0, u, v, [None] * len(u))

        for b in batches:
            for k, c, s in zip(*(_plain(b.column(i)) for i in range(3))):
                if k != key:
                    yield from close()
                    key, contents, sets, held, over = k, [], [], 0, False
                contents.append(c)
                sets.append(s)
                held += len(s)
                if rows is not None and len(contents) > 1 and (len(contents) > rows or held > size):
                    over = True
                    yield out(1, [key] * len(contents), contents, sets)
                    contents, sets, held = [], [], 0
        yield from close()
        if few[0]:
            yield edges()

    return run


def _prefix_keys(long_set: int):
    """Two sets of similarity 0.8 share one of their first n - ceil(0.8 n) + 1 shingles in sorted order.
    Sets of more than ``long_set`` shingles, and those they may be similar to, meet in one bucket of
    their own instead."""

    def run(batches):
        for b in batches:
            keys, contents, sets = [], [], []
            for k, c, s in zip(*(b.column(i).to_pylist() for i in range(3))):
                x, k = np.frombuffer(s, dtype=np.uint64), np.uint64(k & (1 << 64) - 1)
                own = []
                with np.errstate(over="ignore"):
                    if x.size <= long_set:
                        own += mix64(x[: x.size - int(np.ceil(SIMILARITY * x.size - 1e-9)) + 1] + k).view(np.int64).tolist()
                    if x.size >= SIMILARITY * long_set:
                        own += mix64(np.array([k ^ _SEED[63]])).view(np.int64).tolist()
                keys += own
                contents += [c] * len(own)
                sets += [s] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(contents, pa.int64()), pa.array(sets, pa.binary())], ["key", "content", "shingles"])

    return run


def _block_pairs(rows: DataFrame, bucket_rows: int, bucket_bytes: int) -> DataFrame:
    """The contents of each bucket ``(key, content, shingles)`` dealt into blocks, once for each pair of
    blocks: any two contents meet in one of the pairs, which holds two blocks however large the bucket is."""
    size = rows.groupBy(F.col("key").alias("bucket")).agg(F.greatest(
        F.lit(1), F.ceil(F.count(F.lit(1)) / bucket_rows), F.ceil(F.sum(F.octet_length("shingles")) / bucket_bytes)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    return (rows.join(size, F.col("key") == F.col("bucket")).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "content", "shingles"))


def one_of_equal_buckets(collided: DataFrame) -> DataFrame:
    """``collided`` without the keys whose contents are those of another key: they give the same links."""
    of = F.xxhash64("content").cast("decimal(38,0)")
    each = collided.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(of).alias("h"), F.min("content").alias("a"), F.max("content").alias("b"))
    return collided.join(each.groupBy("n", "h", "a", "b").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def content_links(collided: DataFrame, sets: DataFrame, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES, long_set: int = LONG_SET,
                  scratch: Scratch | None = None) -> DataFrame:
    """Edges ``(u, v)`` between contents: spanning forests of the verified links of every bucket.
    ``collided (key, content)`` may mark buckets as ``large``; these are keyed again at once, so that
    none moves to one task whole."""
    scratch = scratch or Scratch(collided.sparkSession)
    large = collided.filter("large").distinct() if "large" in collided.columns else collided.limit(0)
    if large.isEmpty():
        large = None
    else:
        collided = collided.filter(~F.col("large"))

    def with_sets(rows):
        return rows.join(sets, "content").select("key", "content", "shingles")

    def verified(rows, limit, name):
        found = scratch.written(rows.repartition("key").sortWithinPartitions("key").mapInArrow(
            _verify(limit, bucket_bytes), "kind byte, u long, v long, shingles binary"), name)
        over = found.filter("kind = 1").select(F.col("u").alias("key"), F.col("v").alias("content"), "shingles")
        return found.filter("kind = 0").select("u", "v"), over

    edges, over = verified(with_sets(collided), bucket_rows, "paragraph-links")
    if large is not None:
        over = over.union(with_sets(large))
    elif over.isEmpty():
        return edges
    again = over.mapInArrow(_prefix_keys(long_set), "key long, content long, shingles binary")
    more, over = verified(again, bucket_rows, "paragraph-links2")
    edges = edges.union(more)
    if over.isEmpty():
        return edges
    more, _ = verified(_block_pairs(over, bucket_rows, bucket_bytes), None, "paragraph-links3")
    return edges.union(more)


def _texts(batches, lines: bool = False):
    """(row, word hashes, starts and ends of words) of the texts in column 0, with ``lines`` also the number of each
    word's line; row holds the other columns."""
    held, size = [], 0

    def tokenised():
        texts = [t for t, _ in held]
        data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        start, end = word_spans(data)
        h = word_hashes(data, start, end)
        edge = np.searchsorted(start, begin)
        if lines:
            line = np.cumsum(np.bincount(np.searchsorted(start, np.flatnonzero(data == 10)), minlength=start.size + 1))
        for k, (_, row) in enumerate(held):
            own = slice(edge[k], edge[k + 1])
            yield row, h[own], start[own] - begin[k], end[own] - begin[k], *([line[own]] if lines else [])

    for b in batches:
        for text, *row in zip(*map(_plain, b.columns)):
            if held and size + len(text) > BLOCK_BYTES:
                yield from tokenised()
                held, size = [], 0
            held.append((text, row))
            size += len(text)
    if held:
        yield from tokenised()


def _with_texts(docs: DataFrame, rows: DataFrame, columns: list) -> DataFrame:
    """``text, of_id, of_key, rows``: the rows of each text that has any, once for each place. A NULL id is
    two columns, so that one exchange of the rows serves both the grouping and the join."""
    place = ["_lf_id", "_lf_none", "of_key"]
    asked = (rows.withColumn("_lf_id", F.coalesce("of_id", F.lit(0).cast("long"))).withColumn("_lf_none", F.col("of_id").isNull())
             .groupBy(*place).agg(F.collect_list(F.struct(*columns)).alias("rows")))
    d = _source(docs).select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("_lf_id"), F.col("doc_id").isNull().alias("_lf_none"), F.col("text_key").alias("of_key"), "text")
    return d.join(asked, place).select("text", F.when(~F.col("_lf_none"), F.col("_lf_id")).alias("of_id"), "of_key", "rows")


def _contexts(width: int):
    """32 bits of the hashes of up to ``width`` words before (nearest first) and after each asked span, on the
    sides where more may be shared, and of its own words where they are asked for."""

    def run(batches):
        rows, held = [], 0

        def flush():
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["r_id", "r_key", "r_begin", "r_end", "context0", "context1", "inner"])
            rows.clear()
            return made

        for (i, k, asked), h, _, _ in _texts(batches):
            h = (h >> np.uint64(32)).astype(np.uint32)
            for r in asked:
                x, y = r["r_begin"], r["r_end"]
                rows.append((i, k, x, y, h[max(0, x - width):x][::-1].tobytes() if r["more0"] else None, h[y:y + width].tobytes() if r["more1"] else None,
                             h[x:y].tobytes() if r["ends"] else None))
                held += sum(len(c) for c in rows[-1][4:] if c)
                if len(rows) >= 4096 or held > BLOCK_BYTES:
                    yield flush()
                    held = 0
        if rows:
            yield flush()

    return run


#: After a difference, words to skip in either text before the next ``SHINGLE`` equal words; fewest first.
_SKIPS = sorted(((a, b) for a in range(SKIP + 1) for b in range(SKIP + 1) if a + b), key=lambda x: (max(x), sum(x)))


def grow(own: np.ndarray, other: np.ndarray, shared: int, union: int) -> tuple[int, int, int, int, bool]:
    """How far two runs of words go on alike from their beginnings: words of either run, the shared and
    all shingles with those given, and whether more of ``other`` could matter. Equal words are always
    taken, words beyond a difference where the shingles of all that is taken are similar by ``SIMILARITY``."""
    a = b = far_a = far_b = 0
    s, u, best = shared, union, (shared, union)
    sizes, short = (own.size, other.size), other.size <= 64
    if short:  # of the own words no more than differences may skip
        own, other = own[:2 * other.size + 16].tolist(), other.tolist()
    first = True
    while True:
        n = run = min(sizes[0] - a, sizes[1] - b)
        if n and own[a] != other[b]:
            run = 0
        elif short:
            run = 1 if n else 0
            while run < n and own[a + run] == other[b + run]:
                run += 1
        elif n:
            differ = own[a:a + n] != other[b:b + n]
            run = int(differ.argmax())
            run = run if differ[run] else n
        new = run if first and shared else max(0, run - SHINGLE + 1)
        s, u = s + new, u + 2 * run - new
        a, b = a + run, b + run
        if run and (first or s >= SIMILARITY * u - 1e-9):
            far_a, far_b, best = a, b, (s, u)
        first = False
        x, y = own[a:a + SKIP + SHINGLE], other[b:b + SKIP + SHINGLE]
        if not short:
            x, y = x.tolist(), y.tolist()
        for i, j in _SKIPS if not set(x).isdisjoint(y) else ():
            if len(x) - i >= SHINGLE <= len(y) - j and x[i] == y[j] and x[i:i + SHINGLE] == y[j:j + SHINGLE]:
                a, b, u = a + i, b + j, u + i + j
                break
        else:
            return far_a, far_b, *best, sizes[0] > a and sizes[1] - b < SKIP + SHINGLE


def shared_ends(own: np.ndarray, other: np.ndarray) -> tuple[int, int, int, int] | None:
    """Where the first shingle that two runs of words share begins and the last one ends, in either run;
    None if they share none."""
    def shingles(h):
        h = h.tolist()
        return list(zip(*(h[k:] for k in range(SHINGLE))))

    a, b = shingles(own), shingles(other)
    first = {}
    last = {}
    for k, s in enumerate(b):
        first.setdefault(s, k)
        last[s] = k
    shared = [k for k, s in enumerate(a) if s in last]
    if not shared:
        return None
    x, y = shared[0], shared[-1]
    return x, y + SHINGLE, first[a[x]], last[a[y]] + SHINGLE


_GROWN = ("of_id long, of_key long, begin int, end int, r_id long, r_key long, r_begin int, r_end int, shared long, whole long, "
          "more0 boolean, more1 boolean, ends boolean, least int, start int, size int, units array<long>")


class _Growing:
    """A span that grows: its words ``at``, those of the kept unit's text ``r_at``, shared and all shingles,
    and on which sides ``more`` may be shared."""

    def __init__(self, r: dict, h: np.ndarray, line: np.ndarray, width: int):
        self.r, self.h, self.line = r, h, line
        self.at, self.r_at, self.s, self.u = [r["begin"], r["end"]], [r["r_begin"], r["r_end"]], r["shared"], r["whole"]
        self.more, self.context = [r["more0"], r["more1"]], [np.frombuffer(r[f"context{side}"] or b"", dtype=np.uint32) for side in (0, 1)]
        self.none = False
        near = [x[:width] for x in self.context]
        full = [x.size == width for x in near]
        if r["ends"]:  # of a similar unit only what lies between its first and last shared shingle
            inner = np.frombuffer(r["inner"], dtype=np.uint32)
            found = shared_ends(h[self.at[0]:self.at[1]], inner)
            if found is None:
                self.none = True
                return
            x, y, r_x, r_y = found
            near = [np.concatenate([inner[:r_x][::-1], near[0]]), np.concatenate([inner[r_y:], near[1]])]
            self.at, self.r_at = [self.at[0] + x, self.at[0] + y], [self.r_at[0] + r_x, self.r_at[0] + r_y]
            self.more = [r_x < r_y] * 2
        self._grow(near, full)

    def again(self, width: int) -> None:
        near = [self.context[side][abs(self.r_at[side] - self.r[place]):][:width] for side, place in ((0, "r_begin"), (1, "r_end"))]
        self._grow(near, [x.size == width for x in near])

    def _grow(self, near, full):
        begun, ends = list(self.r_at), list(self.more)
        # Both sides grow in turn, so that what one side takes counts for the other.
        taken = None
        for side in (0, 1, 0):
            if not ends[side] or not side and taken == (self.s, self.u):
                continue
            other = near[side][abs(self.r_at[side] - begun[side]):]
            x = self.at[side]
            own = self.h[x:] if side else self.h[self.r["least"]:x][::-1]
            far, r_far, self.s, self.u, spent = grow(own, other, self.s, self.u)
            self.at[side] += far if side else -far
            self.r_at[side] += r_far if side else -r_far
            self.more[side] = bool(full[side] and spent)
            taken = taken if side else (self.s, self.u)
        for side in (0, 1):
            if not self.more[side]:
                self.at[side] = self._whole_line(side)

    def _whole_line(self, side: int) -> int:
        """Where a side ends that grows no more: of the outer line of several, fewer than ``SHINGLE`` words are
        alike by chance and stay, unless they are the whole line."""
        line, edge = self.line, self.at[side]
        first, beyond, inside = (edge - 1, edge, self.at[0]) if side else (edge, edge - 1, self.at[1] - 1)
        if line[first] == line[inside] or not 0 <= beyond < line.size or line[beyond] != line[first]:
            return edge
        to = int(np.searchsorted(line, line[first], side="left" if side else "right"))
        return to if abs(to - edge) < SHINGLE else edge

    def row(self, start: np.ndarray, end: np.ndarray) -> tuple:
        x, y = self.at
        return (x, y, self.r["r_id"], self.r["r_key"], *self.r_at, self.s, self.u, *self.more, False, self.r["least"], int(start[x]), int(end[y - 1] - start[x]),
                tuple(self.r["units"]))


def _grown(widths: list[int]):
    """The asked rows with the spans grown with contexts of ``widths[0]`` words, then with the next ones where
    these are used up; the contexts have as many words as all widths. Spans that have become the same grow
    on as one."""
    names = [c.split()[0] for c in _GROWN.split(", ")]
    kinds = [*[pa.int64()] * 2, *[pa.int32()] * 2, *[pa.int64()] * 2, *[pa.int32()] * 2, *[pa.int64()] * 2, *[pa.bool_()] * 3, *[pa.int32()] * 3, pa.list_(pa.int64())]

    def run(batches):
        rows = []

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
            rows.clear()
            return made

        for (i, k, asked), h, start, end, line in _texts(batches, lines=True):
            h = (h >> np.uint64(32)).astype(np.uint32)
            spans = [g for r in asked if not (g := _Growing(r, h, line, widths[0])).none]
            for width in widths[1:]:
                rows += [(i, k, *g.row(start, end)) for g in spans if not any(g.more)]
                spans = list({g.row(start, end): g for g in spans if any(g.more)}.values())
                for g in spans:
                    g.again(width)
            rows += [(i, k, *g.row(start, end)) for g in spans]
            if len(rows) >= 4096:
                yield flush()
        if rows:
            yield flush()

    return run


def grown_spans(docs: DataFrame, rows: DataFrame, scratch: Scratch, width: int = CONTEXT) -> DataFrame:
    """``rows`` of units that are to go, with the span that goes with each: equal units that overlap or
    follow each other as those they repeat do are one chain (a similar unit may begin and end elsewhere,
    and is alone), and a chain takes in the words to both sides that are shared with the text around the
    units it repeats. A similar unit is first cut back to the shingles it shares with that unit, and goes
    not at all if it has none (it may be linked through others). In the kept unit's own text a span does
    not grow over that unit. Contexts have ``width`` words; a chain whose context is used up is compared again
    with eight times as many, and where these are used up too with eight times as many again in the same round."""
    f = F.col("first")
    one = rows.select(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "word", "words", f["doc_id"].alias("r_id"), f["text_key"].alias("r_key"),
        f["word"].alias("r_word"), f["words"].alias("r_words"), (F.col("content") == f["content"]).alias("equal"), (F.col("n_units") * 4 + F.col("kind")).alias("unit"))
    alike = ["of_id", "of_key", "r_id", "r_key", "shift", "equal"]
    one = one.withColumn("shift", F.col("word") - F.col("r_word")).repartition(*alike).distinct()
    w = Window.partitionBy(*alike).orderBy("word", "words", "unit")
    before = F.max(F.col("word") + F.col("words")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    chains = one.withColumn("new", F.when(F.col("equal") & (before >= F.col("word")), 0).otherwise(1))
    chains = chains.withColumn("chain", F.sum("new").over(w)).groupBy(*alike, "chain").agg(
        F.min("word").alias("begin"), F.max(F.col("word") + F.col("words")).alias("end"), F.min("r_word").alias("r_begin"),
        F.max(F.col("r_word") + F.col("r_words")).alias("r_end"), F.collect_list("unit").alias("units"))
    # What similar units share is not counted.
    same_text = F.col("of_id").eqNullSafe(F.col("r_id")) & (F.col("of_key") == F.col("r_key"))
    chains = (chains.withColumn("shared", F.when(F.col("equal"), F.col("end") - F.col("begin") - (SHINGLE - 1)).otherwise(0).cast("long"))
              .withColumn("ends", ~F.col("equal")).withColumn("least", F.when(same_text, F.least("begin", "r_end")).otherwise(0))
              .drop("shift", "equal", "chain"))
    todo = scratch.written(chains.withColumn("whole", F.col("shared")).withColumn("more0", F.lit(True)).withColumn("more1", F.lit(True)), "paragraph-chains")
    done, widths = [], [width]
    while True:
        place = ["r_id", "r_key", "r_begin", "r_end"]
        asked = todo.groupBy(F.col("r_id").alias("of_id"), F.col("r_key").alias("of_key"), "r_begin", "r_end").agg(
            *[F.max(c).alias(c) for c in ("ends", "more0", "more1")])
        near = _with_texts(docs, asked, ["r_begin", "r_end", "ends", "more0", "more1"]).mapInArrow(
            _contexts(sum(widths)), "r_id long, r_key long, r_begin int, r_end int, context0 binary, context1 binary, inner binary")
        # A NULL id as two columns, so that one exchange serves both the grouping and the join.
        known = lambda d: d.withColumn("no_id", F.col("r_id").isNull()).withColumn("r_id", F.coalesce("r_id", F.lit(0).cast("long")))
        asked = known(todo).join(known(near).dropDuplicates([*place, "no_id"]), [*place, "no_id"])
        asked = asked.withColumn("r_id", F.when(~F.col("no_id"), F.col("r_id")))
        texts = _with_texts(docs, asked, ["begin", "end", *place, "shared", "whole", "more0", "more1", "ends", "least", "units", F.when(F.col("more0"), F.col("context0")).alias("context0"),
                                           F.when(F.col("more1"), F.col("context1")).alias("context1"), F.when(F.col("ends"), F.col("inner")).alias("inner")])
        grown = scratch.written(texts.mapInArrow(_grown(widths), _GROWN), "paragraph-grown")
        done.append(grown.filter("NOT more0 AND NOT more1"))
        todo = grown.filter("more0 OR more1").distinct()
        scratch.free()
        if todo.isEmpty():
            break
        widths = [8 * widths[-1], 64 * widths[-1]]  # two steps in a round, as each round reads the texts
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def repeated_units(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per unit that repeats in ``docs (doc_id, text, ...)``: ``doc_id, text_key, kind, start,
    size`` (bytes of the UTF-8 text), ``words``, ``component_id`` (smallest doc_id with a unit of the
    component), ``n_units`` (the first unit and those that don't overlap it), and ``kept`` (true for the
    first unit). The span of a unit that is not kept takes in what its text shares with the first unit's
    text on both sides of it.

    Units are ordered by doc_id (NULL first), text key and start. NULL, empty and short texts have no
    units; rows that repeat whole (id and text) count as one place, so both are kept or cut alike;
    other columns are ignored; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession)
    units = scratch.written(find_units(docs), "paragraph-units")
    pairs = scratch.written(colliding(units, hot_keys(units, docs.count()), bucket_rows, fitting=True).drop("distinct"), "paragraph-pairs")
    collided = count_hot(pairs, bucket_rows)
    # Units whose content stands once and meets no other are done with.
    places = units.filter("part IS NULL").drop("part", "rows")
    again = places.groupBy("content").count().filter("count > 1").select("content").union(pairs.select("content")).distinct()
    every, units = units, scratch.written(places.join(again, "content", "left_semi"), "paragraph-places")
    scratch.free(every)
    place = F.struct("doc_id", "text_key", "start", "size", "word")
    near = pairs.select("content").distinct().withColumn("near", F.lit(True))
    classes = scratch.written(units.groupBy("content").agg(F.min(place).alias("first"), F.max("words").alias("words"), F.count(F.lit(1)).alias("n"))
                              .join(near, "content", "left").filter("n > 1 OR near")
                              .select("content", F.struct("first.*", "words", "content").alias("first"), "n", "near"), "paragraph-classes")
    sets = scratch.written(shingle_sets(docs, classes.filter("near").select("first.doc_id", "first.text_key", "first.start", "first.size", "content")), "paragraph-sets")
    scratch.free()
    linked = components(content_links(one_of_equal_buckets(collided), sets, bucket_rows, scratch=scratch), "paragraph")
    scratch.free(pairs, sets)
    named = classes.join(linked.withColumnRenamed("node", "content"), "content", "left").select(
        "content", "first", "n", F.coalesce("label", "content").alias("label"))
    total = named.groupBy("label").agg(F.min("first").alias("first"), F.sum("n").alias("n_units")).filter("n_units > 1")
    total = scratch.written(named.select("content", "label").join(total, "label").select("content", "first", "n_units"), "paragraph-named")
    scratch.free(classes)
    f = F.col("first")
    same_text = f["doc_id"].eqNullSafe(F.col("doc_id")) & (f["text_key"] == F.col("text_key"))
    # Units that overlap the kept one in its own text are no repeats of it.
    own = same_text & (F.col("start") < f["start"] + f["size"]) & (f["start"] < F.col("start") + F.col("size"))
    rows = scratch.written(units.join(total, "content").withColumn("own", own)
                           .withColumn("kept", same_text & (F.col("start") == f["start"]) & (F.col("size") == f["size"])), "paragraph-repeats")
    scratch.free(units, total)
    around = rows.filter("own").groupBy(f["content"].alias("of")).agg(F.count(F.lit(1)).alias("n_own"))
    rows = rows.join(around, f["content"] == F.col("of"), "left").drop("of")
    rows = rows.withColumn("n_units", F.col("n_units") - F.coalesce("n_own", F.lit(1)) + 1).drop("n_own").filter("n_units > 1")
    kept = rows.filter("kept").select("doc_id", "text_key", "kind", "start", "size", "words", F.col("first.doc_id").alias("component_id"), "n_units", "kept")
    spans = grown_spans(docs, rows.filter("NOT own").drop("kept", "own", "start", "size"), scratch).withColumn("unit", F.explode("units"))
    return kept.union(spans.select(
        F.col("of_id").alias("doc_id"), F.col("of_key").alias("text_key"), F.pmod("unit", F.lit(4)).cast("byte").alias("kind"), "start", "size",
        (F.col("end") - F.col("begin")).alias("words"), F.col("r_id").alias("component_id"), F.shiftright("unit", 2).alias("n_units"), F.lit(False).alias("kept")))


def _cut(batches):
    for b in batches:
        spans = b.column(b.schema.get_field_index("_lf_spans")).to_pylist()
        texts = column_bytes(b, "_lf_text")
        out = []
        for text, own in zip(texts, spans):
            if not own:
                out.append(text)
                continue
            keep, at = [], 0
            for s, n in sorted((p["start"], p["size"]) for p in own):
                if s > at:
                    keep.append(text[at:s])
                e = s + n
                at = max(at, e + (text[e:e + 1].isspace()))
            keep.append(text[at:])
            out.append(b"".join(keep))
        yield b.drop_columns(["_lf_spans", "_lf_text"]).append_column("_lf_cut", pa.array(out, pa.binary()))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated units other than the first of each component cut out of ``text``
    (with one white-space byte after each); a column ``n_chars`` becomes the new length. Rows and all
    other columns stay; a text that is nothing but repeats becomes empty."""
    spans = (repeated_units(docs).filter(~F.col("kept"))
             .groupBy(F.col("doc_id").alias("_lf_id"), F.col("text_key").alias("_lf_key"))
             .agg(F.collect_set(F.struct("start", "size")).alias("_lf_spans")))
    keep = [c for c in docs.columns if c != "text"]
    j = docs.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col("_lf_id")) & (text_key("text") == F.col("_lf_key")), "left")
    j = j.select(*[F.col(f"`{c}`") for c in keep], "_lf_spans", F.col("text").cast("binary").alias("_lf_text"))
    schema = j.drop("_lf_spans", "_lf_text").withColumn("_lf_cut", F.lit(None).cast("binary")).schema
    cut = j.mapInArrow(_cut, schema).withColumn("text", F.col("_lf_cut").cast("string")).drop("_lf_cut")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])
