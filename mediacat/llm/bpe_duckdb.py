"""Byte-level BPE: DuckDB recursive queries, run inside every partition, contract words until no pair is left.

The words are the matches of the tokenizer's pattern, found on whole blocks of code points. Each distinct word of a block goes
to DuckDB as rows (word, position, token); a step of the recursion joins neighbouring tokens with the merge
table and contracts every word's leftmost pair of minimum rank, and a word is done when a step finds no pair. Decoding is
an ordered aggregation of the tokens' bytes. A worker keeps a bounded table of words it has met.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import slices, text_bytes

RANKS = "byte_bpe_50k.tiktoken"
BLOCK_CHARS = 1 << 20
KNOWN_WORDS = 600_000
BATCH_ROWS = 400_000
LONG_WORD = 256
"""Words above this many bytes contract all the pairs of the minimum rank in one step, leftmost first."""

LETTER, NUMBER, OTHER, BLANK = 0, 1, 2, 3

# start(w, pos, tok) is given. nxt is the position of the next token, nx its number.
WORD_STEPS = """
WITH RECURSIVE step(n, w, pos, nxt, tok, nx) AS (
  SELECT 0::INT, w, pos, pos + 1, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) FROM start
  UNION ALL
  SELECT n + 1, s.w, s.pos,
         CASE WHEN s.pos = b.best THEN b.past ELSE s.nxt END,
         CASE WHEN s.pos = b.best THEN b.m ELSE s.tok END,
         CASE WHEN s.pos = b.best THEN b.after WHEN s.nxt = b.best THEN b.m ELSE s.nx END
  FROM step s JOIN (
    SELECT a.w, a.best, a.m, a.gone, z.nxt AS past, z.nx AS after
    FROM (
      SELECT p.w, min(r.m) AS m, arg_min(p.pos, r.m::BIGINT * 4294967296 + p.pos) AS best,
             arg_min(p.nxt, r.m::BIGINT * 4294967296 + p.pos) AS gone
      FROM step p JOIN merges r ON r.l = p.tok AND r.r = p.nx GROUP BY p.w
    ) a JOIN step z ON z.w = a.w AND z.pos = a.gone
  ) b ON b.w = s.w
  WHERE s.pos <> b.gone
)
SELECT s.w, s.pos, s.tok FROM step s JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) f ON s.w = f.w AND s.n = f.n
"""

# The same for long words: all pairs of the minimum rank, of overlapping ones every other from the left. In a
# vocabulary whose tokens all come out of their own merges no pair of a lower rank can arise in between.
LONG_STEPS = """
WITH RECURSIVE step(n, w, pos, tok) AS (
  SELECT 0::INT, w, pos, tok FROM start
  UNION ALL
  SELECT n + 1, w, pos, CASE WHEN hit THEN m ELSE tok END FROM (
    SELECT *, lag(hit, 1, false) OVER (PARTITION BY w ORDER BY pos) AS gone FROM (
      SELECT n, w, pos, tok, m, rank = m AND (row_number() OVER (PARTITION BY w, rank = m, island ORDER BY pos)) % 2 = 1 AS hit FROM (
        SELECT *, i - row_number() OVER (PARTITION BY w, coalesce(rank = m, false) ORDER BY pos) AS island FROM (
          SELECT p.n, p.w, p.pos, p.tok, p.i, r.m AS rank, min(r.m) OVER (PARTITION BY p.w) AS m
          FROM (
            SELECT n, w, pos, tok, row_number() OVER (PARTITION BY w ORDER BY pos) AS i,
                   lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nx
            FROM step WHERE n < {steps}
          ) p LEFT JOIN merges r ON r.l = p.tok AND r.r = p.nx
        )
      ) WHERE m IS NOT NULL
    )
  ) WHERE NOT coalesce(gone, false)
)
SELECT s.w, s.pos, s.tok, f.n FROM step s JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) f ON s.w = f.w AND s.n = f.n
"""

DECODE = """
SELECT d.w, string_agg(hex(v.bytes), '' ORDER BY d.pos) AS hexed, list(d.tok ORDER BY d.pos) AS toks
FROM done d JOIN vocab v ON v.tok = d.tok GROUP BY d.w
"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Words:
    """Encodes distinct words with DuckDB and remembers a bounded number of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for name, columns in (
            ("merges", {"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "m": pa.array(merged, pa.int32())}),
            ("vocab", {"tok": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())}),
        ):
            self.con.register("given", pa.table(columns))
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.coded: list[bytes] = []
        self.plain: list[bytes] = []
        self.older: tuple[dict[int, int], list[bytes], list[bytes]] = {}, [], []

    def age(self) -> None:
        """Forget the older half of the known words; of the newer half those stay that are met again."""
        older = self.known, self.coded, self.plain
        self.clear()
        self.older = older

    def recall(self, hashes: list[int]) -> list[int]:
        """Take over what the older half knows; returns the hashes that it does not know."""
        known, coded, plain = self.older
        missing = []
        for h in hashes:
            number = known.get(h)
            if number is None:
                missing.append(h)
                continue
            self.known[h] = len(self.coded)
            self.coded.append(coded[number])
            self.plain.append(plain[number])
        return missing

    def contract(self, words: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
        """Number, ids (little-endian, 32 bits) and decoded bytes of each word."""
        whole = [self.ranks.get(w) for w in words]
        short = [i for i, w in enumerate(words) if whole[i] is None and len(w) <= LONG_WORD]
        rows: list[pa.Table] = [pa.table({
            "w": pa.array([i for i, t in enumerate(whole) if t is not None], pa.int32()),
            "pos": pa.array([0 for t in whole if t is not None], pa.int32()),
            "tok": pa.array([t for t in whole if t is not None], pa.int32()),
        })]
        at = 0
        while at < len(short):
            stop, size = at, 0
            while stop < len(short) and size < BATCH_ROWS:
                size += len(words[short[stop]])
                stop += 1
            rows.append(self._run(WORD_STEPS, self._start(words, short[at:stop])))
            at = stop
        for i, w in enumerate(words):
            if whole[i] is None and len(w) > LONG_WORD:
                rows.append(self._long(self._start(words, [i]), len(w)))
        self.con.register("done", pa.concat_tables(rows))
        found = self.con.sql(DECODE).to_arrow_table().combine_chunks()
        self.con.unregister("done")
        toks = found.column("toks").combine_chunks()
        coded = toks.flatten().to_numpy().astype("<u4").tobytes()
        ends = (4 * np.concatenate(([0], np.cumsum(toks.value_lengths().to_numpy())))).tolist()
        for w, hexed, a, b in zip(found.column("w").to_pylist(), found.column("hexed").to_pylist(), ends, ends[1:]):
            yield w, coded[a:b], bytes.fromhex(hexed)

    def _start(self, words: list[bytes], numbers: list[int]) -> pa.Table:
        data = np.frombuffer(b"".join(words[i] for i in numbers), np.uint8)
        size = np.array([len(words[i]) for i in numbers])
        pos = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        return pa.table({"w": np.repeat(np.array(numbers, np.int32), size), "pos": pos.astype(np.int32), "tok": self.byte[data]})

    def _run(self, query: str, start: pa.Table) -> pa.Table:
        self.con.register("start", start)
        out = self.con.sql(query).to_arrow_table()
        self.con.unregister("start")
        return out.select(["w", "pos", "tok"]) if "n" not in out.column_names else out

    def _long(self, start: pa.Table, size: int) -> pa.Table:
        """In rounds of a bounded number of steps, since a recursive query keeps the rows of every step."""
        steps = max(1, 2 * BATCH_ROWS // size)
        while True:
            start = self._run(LONG_STEPS.format(steps=steps), start)
            done = start.column("n")[0].as_py() < steps
            start = start.select(["w", "pos", "tok"])
            if done:
                return start

    def learn(self, hashes: list[int], words: list[bytes]) -> None:
        first = len(self.coded)
        self.coded += [b""] * len(words)
        self.plain += [b""] * len(words)
        for number, coded, plain in self.contract(words):
            self.coded[first + number], self.plain[first + number] = coded, plain
        self.known.update(zip(hashes, range(first, first + len(words))))


_KINDS: list[np.ndarray] = []
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def kinds() -> np.ndarray:
    """Letter, number, white space or other, for each code point."""
    if not _KINDS:
        out = np.full(0x110000, OTHER, np.uint8)
        whole = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
            for match in regex.finditer(pattern, whole):
                for a, b in ((match.start(), match.end()),):
                    a, b = (x if x <= 0xD800 else x + 0x800 for x in (a, b))
                    out[a:b] = kind
        out[0xD800:0xE000] = OTHER
        _KINDS.append(out)
    return _KINDS[0]


def word_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Offsets at which the matches of the pattern begin. points: code points of texts end to end; ends: the offsets of the texts."""
    n = len(points)
    kind = kinds()[points]
    opens = np.ones(n, bool)
    opens[1:] = kind[1:] != kind[:-1]
    heads = ends[:-1][ends[1:] > ends[:-1]]
    opens[heads] = True
    begin = np.flatnonzero(opens)
    stop = np.append(begin[1:], n)
    of_run = kind[begin]
    is_head = np.zeros(n + 1, bool)
    is_head[heads] = True
    is_head[n] = True
    last = is_head[stop]  # the run ends its text
    blank = of_run == BLANK
    space_ends = blank & ~last & (points[stop - 1] == 32)
    joined = np.append(False, space_ends[:-1])  # the last space belongs to this run
    start = np.zeros(n + 1, bool)
    word = ~blank
    start[begin[word] - joined[word]] = True
    size = stop - begin
    start[begin[blank & (last | (size > 1) | ~space_ends)]] = True
    start[stop[blank & ~last & ~space_ends & (size > 1)] - 1] = True
    quote = np.flatnonzero(word & (size == 1) & (points[begin] == 39) & ~joined & ~last)
    quote = quote[of_run[quote + 1] == LETTER] if len(quote) else quote
    if len(quote):
        padded = np.append(points, 0)
        at, room = stop[quote], size[quote + 1]
        one, two = padded[at], padded[at + 1]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = (room >= 2) & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        taken = np.where(single, 1, np.where(double, 2, 0))
        cut = taken > 0
        start[at[cut]] = False
        rest = cut & (room > taken)
        start[at[rest] + taken[rest]] = True
    return np.flatnonzero(start[:n])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        pair = []
        for base in (_FACTOR, _INVERSE):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            pair.append(np.cumprod(x))
        _POWERS[size] = tuple(pair)
    return _POWERS[size]


def word_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every word, from one running sum."""
    powers, inverse = _powers(len(points))
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * powers[: len(points)])))
    stops = np.append(starts[1:], len(points))
    out = (total[stops] - total[starts]) * inverse[starts]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0x94D049BB133111EB) + (stops - starts).astype(np.uint64)


_WORDS: dict[bytes, Words] = {}


def _worker_words(data: bytes) -> Words:
    key = hashlib.sha256(data).digest()
    if key not in _WORDS:
        _WORDS.clear()
        _WORDS[key] = Words(read_ranks(data))
    return _WORDS[key]


def encode_block(words: Words, texts: list[str]) -> list[tuple[bytes, bytes]]:
    """Ids and decoded bytes of each text."""
    whole = "".join(texts)
    if not whole:
        return [(b"", b"")] * len(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    ends = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    starts = word_starts(points, ends)
    hashes = word_hashes(points, starts)
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    listed = distinct.tolist()
    if len(words.known) > KNOWN_WORDS // 2:
        words.age()
    missing = set(words.recall([h for h in listed if h not in words.known]))
    if missing:
        new = [i for i, h in enumerate(listed) if h in missing]
        stops = np.append(starts[1:], len(points))
        at = first[new]
        words.learn([listed[i] for i in new], [whole[a:b].encode() for a, b in zip(starts[at].tolist(), stops[at].tolist())])
    number = np.array([words.known[h] for h in listed])[inverse]
    cuts = np.searchsorted(starts, ends)
    out = []
    for text, a, b in zip(texts, cuts[:-1].tolist(), cuts[1:].tolist()):
        mine = number[a:b].tolist()
        plain = b"".join(map(words.plain.__getitem__, mine))
        if plain == text.encode():
            out.append((b"".join(map(words.coded.__getitem__, mine)), plain))
            continue
        edges = np.append(starts[a:b], ends[0] + (starts[b] if b < len(starts) else len(points)))  # two words share a hash: without the table
        own = [whole[x:y].encode() for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]
        found = {i: (coded, decoded) for i, coded, decoded in words.contract(own)}
        out.append(tuple(b"".join(found[i][part] for i in range(len(own))) for part in (0, 1)))
    return out


def _encoded(data: bytes, with_ids: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_words(data)
        for part in slices(batches, "text", BLOCK_CHARS):
            texts = [t.decode("utf-8", "replace") for t in part.column("text").to_pylist()]
            found = encode_block(words, texts)
            columns = [
                part.column("doc_id"), pa.array([len(c) // 4 for c, _ in found], pa.int64()),
                pa.array([hashlib.sha256(c).hexdigest() for c, _ in found], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for _, d in found], pa.string()),
                pa.array([np.frombuffer(c, "<u4").astype(np.int32) if with_ids else None for c, _ in found], pa.list_(pa.int32())),
                pa.array([d if with_ids else None for _, d in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])

    return run


def encode_documents(docs: DataFrame, ranks_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode whole texts and decode the ids again.

    docs: doc_id, text; other columns are ignored. ranks_path: a tiktoken file that the driver can read (its
    bytes, under a megabyte, travel with the tasks); every single byte must be a token. Returns one row per input row:
    doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256, and with `with_ids` ids and
    decoded. Null and empty texts have no tokens. Bytes that are not UTF-8 count as U+FFFD. An empty table gives no rows.
    """
    with open(ranks_path or public_tokenizers.path(RANKS), "rb") as file:
        data = file.read()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    out = source.mapInArrow(
        _encoded(data, with_ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded binary"
    )
    return out if with_ids else out.drop("ids", "decoded")
