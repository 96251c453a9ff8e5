"""BPE with word ends: a segment tree over the ranks of adjacent pairs names every merge.

A word's symbols are a doubly linked list; leaf i of its tree holds the rank of the pair that begins at symbol i together with i, and
every inner node the least of its two children. The root is therefore the leftmost pair of the lowest rank. A merge changes three
leaves (the pair itself, the one before it, the one it swallows), each in a logarithmic number of steps; a root without a
rank ends the word. Words of like length share a forest: one array holds a tree per row, and a step merges every word's
root at once. Words above `FOREST_SYMBOLS` have a tree of their own, updated in the same way.

The words are found as the vocabulary file says: added tokens first, then its normaliser, then its pattern. No word holds
white space, so texts are cut at ASCII white space and each distinct stretch is worked out once; a worker remembers a
bounded number of them.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from string import ascii_lowercase

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from mediacat.llm.common import slices, text_bytes

VOCABULARY = "word_bpe_49k.json"
BLOCK_BYTES = 4 << 20
KNOWN_STRETCHES = 600_000
FOREST_SYMBOLS = 64
FOREST_WORDS = 4096
NO_PAIR = np.iinfo(np.int64).max
POSITION_BITS = 32

WHITE = re.compile(rb"[ \t-\r]")
PRINTABLE = re.compile(rb"[!-~]+")


class Vocabulary:
    """What a vocabulary file says: added tokens, how texts become words of byte symbols, merges, ids.

    Beyond printable ASCII the file's normaliser and pattern are run by the library they are written for, so that letters and
    lower case are those of its Unicode tables; added tokens, merges and decoding are done here.
    """

    def __init__(self, data: bytes):
        file = json.loads(data)
        model = file["model"]
        library = Tokenizer.from_str(data.decode())
        self.normaliser, self.cutter = library.normalizer, library.pre_tokenizer
        self.pattern = regex.compile(next((p["pattern"]["Regex"] for p in (file["pre_tokenizer"] or {}).get("pretokenizers", ()) if p["type"] == "Split"), ""))
        self.lower = self.cut("aB") == ["ab"]
        self.border = next(iter(self.cut("\0")), None)
        self._check(file, model)
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        symbols = ByteLevel.alphabet()
        self.inner, self.last = np.zeros((2, 1 + max(map(ord, symbols))), np.int64)
        for symbol in symbols:
            self.inner[ord(symbol)], self.last[ord(symbol)] = vocab[symbol], vocab[symbol + suffix]
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        self.added = {t["content"].encode(): t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t.decode() for t, i in self.added.items()}
        self.letters = self.pattern.findall(ascii_lowercase) == [ascii_lowercase] and not any(t.isalpha() for t in self.added)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if longest_first else None

    def _check(self, file: dict, model: dict) -> None:
        """Files that ask for anything else are refused rather than read wrongly."""
        plain_added = not any(
            t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or WHITE.search(t["content"].encode()) for t in file["added_tokens"]
        )
        plain_model = model["type"] == "BPE" and model.get("end_of_word_suffix") and not any(
            model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "unk_token", "fuse_unk")
        )
        plain_ends = file["decoder"] is None and file["post_processor"] is None
        shown = "".join(map(chr, range(0x21, 0x7F)))
        plain_ascii = self.pattern.findall(shown.lower() if self.lower else shown) == self.cut(shown)
        if not (self.border and plain_added and plain_model and plain_ends and plain_ascii and [w for c in " \t\n\v\f\r" for w in self.cut(f"a{c}{c}1")] == ["a", "1"] * 6):
            raise ValueError("this vocabulary file needs a step that is not built here")

    def cut(self, text: str) -> list[str]:
        """The words of a text, a character for each byte."""
        if self.normaliser is not None:
            text = self.normaliser.normalize_str(text)
        return [word for word, _ in self.cutter.pre_tokenize_str(text)]

    def words(self, stretches: list[bytes]) -> list[list[str | int]]:
        """The words of each stretch without ASCII white space, and the ids of the added tokens in it."""
        out: list[list[str | int]] = []
        foreign: list[tuple[list[str | int], str]] = []  # where the words of a part belong, and the part
        for stretch in stretches:
            if self.letters and stretch.isalpha():
                text = stretch.decode()
                out.append([text.lower() if self.lower else text])
                continue
            words: list[str | int] = []
            out.append(words)
            for part in self.special.split(stretch) if self.special else [stretch]:
                if part in self.added:
                    words.append(self.added[part])
                elif PRINTABLE.fullmatch(part):
                    text = part.decode()
                    words += self.pattern.findall(text.lower() if self.lower else text)
                elif part:
                    text = part.decode("utf-8", "replace")
                    if "\0" in text or part != stretch:
                        words += self.cut(text)
                    else:
                        foreign.append((words, text))
        for start in range(0, len(foreign), 500):
            group = foreign[start : start + 500]
            at = 0
            for word in self.cut(" \0 ".join([text for _, text in group])):
                if word == self.border:
                    at += 1
                else:
                    group[at][0].append(word)
        return out

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, `NO_PAIR` if it never merges."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)


def points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)


def merge_forest(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words end to end, and where each word's end; every word has at least one symbol, and all share one tree size."""
    count, longest = len(words), max(map(len, words))
    leaves = 1 << max(0, (longest - 2).bit_length()) if longest > 1 else 1
    width = leaves + 2
    sizes = np.fromiter(map(len, words), np.int64, count)
    heads = np.cumsum(sizes) - sizes
    data = points(words)
    row = np.repeat(np.arange(count), sizes)
    column = np.arange(len(data)) - heads[row]
    last = column == sizes[row] - 1
    symbol = np.zeros((count, width), np.int64)
    symbol[row, column] = np.where(last, vocabulary.last[data], vocabulary.inner[data])
    follows = np.tile(np.arange(1, width + 1), (count, 1))
    before = np.tile(np.arange(-1, width - 1), (count, 1))
    stays = np.zeros((count, width), bool)
    stays[row, column] = True

    def leaf(r: np.ndarray, at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """What a leaf holds: rank and place of the pair at `at`, or nothing."""
        rank = vocabulary.pair_ranks(symbol[r, at], symbol[r, np.minimum(after, width - 1)])
        return np.where((after < sizes[r]) & (rank != NO_PAIR), (rank << POSITION_BITS) | at, NO_PAIR)

    tree = np.full((count, 2 * leaves), NO_PAIR, np.int64)
    paired = ~last
    tree[row[paired], leaves + column[paired]] = leaf(row[paired], column[paired], column[paired] + 1)
    for node in range(leaves - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    flat_tree = tree.reshape(-1)
    live = np.arange(count)
    while True:
        live = live[tree[live, 1] != NO_PAIR]
        if not len(live):
            break
        root = tree[live, 1]
        at = root & ((1 << POSITION_BITS) - 1)
        gone = follows[live, at]
        after = follows[live, gone]
        previous = before[live, at]
        symbol[live, at] = vocabulary.merged[root >> POSITION_BITS]
        follows[live, at] = after
        before[live, np.minimum(after, width - 1)] = at
        stays[live, gone] = False
        has_previous = previous >= 0
        previous = np.maximum(previous, 0)
        tree[live, leaves + np.minimum(gone, leaves - 1)] = NO_PAIR
        tree[live, leaves + np.minimum(at, leaves - 1)] = leaf(live, at, after)
        tree[live[has_previous], leaves + previous[has_previous]] = leaf(live, previous, at)[has_previous]
        nodes = leaves + np.minimum(np.stack((gone, at, previous)), leaves - 1)
        base = live * (2 * leaves)
        while nodes[0, 0] > 1:
            below = base + (nodes & -2)
            nodes >>= 1
            flat_tree[base + nodes] = np.minimum(flat_tree[below], flat_tree[below + 1])
    return symbol[stays], np.cumsum(stays.sum(axis=1))


def merge_tree(vocabulary: Vocabulary, word: str) -> np.ndarray:
    """The ids of one word of any length, by the same tree over flat arrays: some 60 bytes of memory for each of its bytes."""
    size = len(word)
    symbol = array("q", vocabulary.inner[points([word])].tobytes())
    symbol[-1] = int(vocabulary.last[ord(word[-1])])
    leaves = 1 << max(0, (size - 1).bit_length())
    first = np.frombuffer(symbol, np.int64)
    ranks = vocabulary.pair_ranks(first[:-1], first[1:])
    start = np.full(2 * leaves, NO_PAIR, np.int64)
    start[leaves : leaves + size - 1] = np.where(ranks == NO_PAIR, NO_PAIR, (ranks << POSITION_BITS) | np.arange(size - 1))
    span = leaves
    while span > 1:
        start[span // 2 : span] = start[span : 2 * span].reshape(-1, 2).min(axis=1)
        span //= 2
    tree = array("q", start.tobytes())
    del start, first, ranks
    follows, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))
    rank_of, merged, base, mask = vocabulary.rank_of, vocabulary.merged.tolist(), vocabulary.size, (1 << POSITION_BITS) - 1

    def put(at: int, value: int) -> None:
        node = leaves + at
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                return
            tree[node] = least

    def pair(a: int, b: int) -> int:
        rank = rank_of.get(symbol[a] * base + symbol[b])
        return NO_PAIR if rank is None else (rank << POSITION_BITS) | a

    while leaves > 1 and tree[1] != NO_PAIR:
        at = tree[1] & mask
        symbol[at] = merged[tree[1] >> POSITION_BITS]
        gone = follows[at]
        after = follows[gone]
        follows[at] = after
        symbol[gone] = -1
        put(gone, NO_PAIR)
        if after < size:
            before[after] = at
            put(at, pair(at, after))
        else:
            put(at, NO_PAIR)
        if before[at] >= 0:
            put(before[at], pair(before[at], at))
    found = np.frombuffer(symbol, np.int64)
    return found[found >= 0].copy()


def merge_words(vocabulary: Vocabulary, words: list[str]) -> dict[str, tuple[bytes, str]]:
    """For each word its ids as little-endian unsigned 32-bit integers, and their decoding: the tokens' strings joined by blanks."""
    out: dict[str, tuple[bytes, str]] = {}
    name = vocabulary.tokens.__getitem__

    def put(part: list[str], ids: np.ndarray, ends: Iterable[int]) -> None:
        coded, plain, start = ids.astype("<u4").tobytes(), list(map(name, ids.tolist())), 0
        for word, end in zip(part, ends):
            out[word] = (coded[4 * start : 4 * end], " ".join(plain[start:end]))
            start = end

    forests: dict[int, list[str]] = {}
    for word in words:
        if len(word) > FOREST_SYMBOLS:
            ids = merge_tree(vocabulary, word)
            put([word], ids, [len(ids)])
        else:
            forests.setdefault((len(word) - 1).bit_length(), []).append(word)
    for group in forests.values():
        for start in range(0, len(group), FOREST_WORDS):
            part = group[start : start + FOREST_WORDS]
            ids, ends = merge_forest(vocabulary, part)
            put(part, ids, ends.tolist())
    return out


class Coder:
    """Encodes stretches between white space, remembers a bounded number of them."""

    def __init__(self, data: bytes):
        self.vocabulary = Vocabulary(data)
        self.known: dict[bytes, tuple[bytes, str]] = {}
        self.older: dict[bytes, tuple[bytes, str]] = {}

    def learn(self, new: set[bytes], cut: list[list[bytes]]) -> None:
        """Work out the new stretches of `cut`; of too many known ones the older half is forgotten."""
        if len(self.known) + len(new) > KNOWN_STRETCHES // 2:
            self.older, self.known = self.known, {}
            new = {s for stretches in cut for s in stretches}
        fresh = []
        for stretch in new:
            if stretch in self.older:
                self.known[stretch] = self.older[stretch]
            else:
                fresh.append(stretch)
        pieces = self.vocabulary.words(fresh)
        distinct = {w for words in pieces for w in words if isinstance(w, str)}
        made = merge_words(self.vocabulary, list(distinct))
        made |= {i: (i.to_bytes(4, "little"), self.vocabulary.tokens[i]) for i in self.vocabulary.added.values()}
        for stretch, words in zip(fresh, pieces):
            if len(words) == 1:
                self.known[stretch] = made[words[0]]
            else:
                found = [made[w] for w in words]
                self.known[stretch] = (b"".join([ids for ids, _ in found]), " ".join([plain for _, plain in found]))

    def encode(self, texts: list[bytes]) -> Iterator[list[tuple[bytes, str]]]:
        """For each text ids and decoded text of its consecutive parts; parts without a token are left out.

        Texts of up to `BLOCK_BYTES` together are worked out together, a longer one part by part.
        """
        if len(texts) == 1:
            yield [found for part in parts(texts[0], BLOCK_BYTES) for found in self._joined([part.split()])]
            return
        for found in self._joined([text.split() for text in texts], empty=True):
            yield [found] if found[0] else []

    def _joined(self, cut: list[list[bytes]], empty: bool = False) -> Iterator[tuple[bytes, str]]:
        known = self.known
        missing = {s for stretches in cut for s in stretches if s not in known}
        if missing:
            self.learn(missing, cut)
        for stretches in cut:
            found = list(map(self.known.__getitem__, stretches))
            coded = b"".join([ids for ids, _ in found])
            if coded or empty:
                yield coded, " ".join([plain for ids, plain in found if ids])


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """Cut a text at white space into parts of about `size` bytes; a longer stretch without white space stays whole."""
    at = 0
    while len(text) - at > size:
        gap = WHITE.search(text, at + size)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.end()
    yield text[at:] if at else text


_CODERS: dict[bytes, Coder] = {}


def _worker_coder(data: bytes) -> Coder:
    key = hashlib.sha256(data).digest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(data)
    return _CODERS[key]


def _encoded(data: bytes, with_ids: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker_coder(data)
        for part in slices(batches, "text", BLOCK_BYTES):
            counts, coded_hashes, plain_hashes, all_ids, all_plain = [], [], [], [], []
            for found in coder.encode(part.column("text").to_pylist()):
                count, of_ids, of_plain, ids, plain = 0, hashlib.sha256(), hashlib.sha256(), [], []
                for coded, decoded in found:
                    of_ids.update(coded)
                    of_plain.update((" " + decoded if count else decoded).encode())
                    count += len(coded) // 4
                    if with_ids:
                        ids.append(coded)
                        plain.append(decoded)
                counts.append(count)
                coded_hashes.append(of_ids.hexdigest())
                plain_hashes.append(of_plain.hexdigest())
                all_ids.append(np.frombuffer(b"".join(ids), "<u4").astype(np.int32) if with_ids else None)
                all_plain.append(" ".join(plain) if with_ids else None)
            columns = [
                part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded_hashes, pa.string()), pa.array(plain_hashes, pa.string()),
                pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_plain, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])

    return run


def encode_documents(docs: DataFrame, vocabulary_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode whole texts and decode the ids again.

    docs: doc_id, text; other columns are ignored. vocabulary_path: a tokenizer file that the driver can read (its bytes, some
    megabytes, travel with the tasks): BPE with word ends over byte symbols, added tokens found in the raw text; a
    file that asks for other steps raises ValueError. Truncation and padding of the file are not applied. Returns one row per
    input row: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256 (UTF-8), and with
    `with_ids` ids and decoded (the tokens' strings joined by blanks, added tokens among them). Null, empty and blank
    texts have no tokens. Bytes that are not UTF-8 count as U+FFFD. An empty table gives no rows.
    """
    with open(vocabulary_path or public_tokenizers.path(VOCABULARY), "rb") as file:
        data = file.read()
    Vocabulary(data)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    out = source.mapInArrow(
        _encoded(data, with_ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"
    )
    return out if with_ids else out.drop("ids", "decoded")
