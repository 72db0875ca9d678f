"""Byte-level BPE: encoding with offsets, and decoding.

Pre-tokenisation runs on arrays. Every code point gets a class from a table; what the pattern looks
ahead for (a contraction, the end of a run of white space) goes into the symbol of the place.
Over symbols the pattern is a machine of eight states. Its steps are functions from states to
states, and their composition is associative, so a scan finds the state at every place: rows of
symbols are composed side by side, the rows' functions are composed by doubling, and a last
sweep from the known states marks the places where a token of the pattern starts. Texts of a batch
lie in one array, divided by a symbol that resets the machine.

The slices go through a cache of merged pairs. Ids and the byte offset at which each begins
are what a text becomes; decoding joins the bytes of the ids.
"""

import base64
import hashlib
import heapq
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

# The pattern that the tables below stand for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters and numbers of Unicode 16 that Python 3.13 does not know yet, and
# white space.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
WHITE = [
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]

DIVIDER = 0xD800  # a code point that no text holds
CHARACTERS = 1 << 20  # texts are scanned together up to so many; a longer text is scanned alone
CACHED, CACHED_LENGTH = 300_000, 48  # slices that a worker remembers, and the longest of them
SHORT = 64  # bytes; longer slices are merged with a heap

OTHER, LETTER, NUMBER, SPACE, END = range(5)
# Symbols: the classes, an apostrophe before a contraction of one or two letters, white space
# inside its run, and the last of a run before something else (a blank joins what follows).
S_OTHER, S_LETTER, S_NUMBER, S_ONE, S_TWO, S_INSIDE, S_BLANK, S_LAST, S_END = range(9)
# States: at a fresh start, in a run of a class, after a blank, with letters of a contraction to go.
FRESH, IN_OTHER, IN_LETTER, IN_NUMBER, IN_SPACE, JOINED, ONE_LEFT, TWO_LEFT = range(8)


def _machine():
    """(next state, token starts here) per symbol and state."""
    state, start = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    runs = {S_OTHER: IN_OTHER, S_LETTER: IN_LETTER, S_NUMBER: IN_NUMBER, S_INSIDE: IN_SPACE}
    for symbol, run in runs.items():
        state[symbol] = run
        start[symbol, run] = start[symbol, JOINED] = False
    for symbol, left in ((S_ONE, ONE_LEFT), (S_TWO, TWO_LEFT)):
        state[symbol] = left
        for before in (IN_OTHER, JOINED):  # inside a run an apostrophe is like any other sign
            state[symbol, before], start[symbol, before] = IN_OTHER, False
    state[S_LETTER, ONE_LEFT], state[S_LETTER, TWO_LEFT] = FRESH, ONE_LEFT
    start[S_LETTER, ONE_LEFT] = start[S_LETTER, TWO_LEFT] = False
    state[S_BLANK], state[S_LAST], state[S_END] = JOINED, FRESH, FRESH
    start[S_END] = False
    return state, start


_STATE, _START = _machine()
_classes = None


def class_table():
    """Class of every code point."""
    global _classes
    if _classes is None:
        first = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
        table = np.zeros(0x110000, np.uint8)
        kinds = np.array(first)
        table[kinds == "L"], table[kinds == "N"] = LETTER, NUMBER
        for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER), (WHITE, SPACE)):
            for low, high in ranges:
                table[low : high + 1] = kind
        table[DIVIDER] = END
        _classes = table
    return _classes


def symbols(points):
    """Symbols of an array of code points that ends with a divider."""
    kind = class_table()[points]
    symbol = np.array([S_OTHER, S_LETTER, S_NUMBER, S_INSIDE, S_END], np.uint8)[kind]
    last = np.flatnonzero(kind[:-1] == SPACE)
    last = last[(kind[last + 1] != SPACE) & (kind[last + 1] != END)]
    symbol[last] = np.where(points[last] == 0x20, S_BLANK, S_LAST)
    quote = np.flatnonzero(points == ord("'"))
    after, second = points[quote + 1], points[np.minimum(quote + 2, len(points) - 1)]
    one = np.isin(after, [ord(c) for c in "stmd"])
    two = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (after == ord(a)) & (second == ord(b))
    symbol[quote[one]], symbol[quote[two]] = S_ONE, S_TWO
    return symbol


def token_starts(symbol):
    """Places where a token of the pattern starts, by a scan over transition functions."""
    n = len(symbol)
    width = max(16, min(1024, 1 << (n.bit_length() // 2)))
    rows = -(-n // width)
    padded = np.full(rows * width, S_END, np.uint8)
    padded[:n] = symbol
    columns = np.ascontiguousarray(padded.reshape(rows, width).T)
    step, begins = _STATE.reshape(-1), _START.reshape(-1)
    index = columns.astype(np.intp) * 8
    # each row's function: its symbols' functions, composed
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for row in index:
        whole = step[row[:, None] + whole]
    # functions of all rows up to each, by doubling
    reach = 1
    while reach < rows:
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        reach *= 2
    state = np.concatenate([[FRESH], whole[:-1, FRESH]]).astype(np.uint8)
    found = np.empty((width, rows), bool)
    for i, row in enumerate(index):
        at = row + state
        found[i] = begins[at]
        state = step[at]
    return np.flatnonzero(found.T.reshape(-1)[:n])


def slices(texts):
    """Per text the list of its slices in order, for a list of texts."""
    joined = chr(DIVIDER).join(texts) + chr(DIVIDER)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    starts = token_starts(symbols(points))
    bounds = np.flatnonzero(points == DIVIDER)
    # a token ends where the next starts, or at its text's end
    ends = np.append(starts[1:], len(points))
    owner = np.searchsorted(bounds, starts)
    ends = np.minimum(ends, bounds[owner]) if len(starts) else ends[:0]
    parts = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    return [parts[cuts[i] : cuts[i + 1]] for i in range(len(texts))]


def batches(texts):
    """Texts in lists of at most CHARACTERS code points, or of one text."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > CHARACTERS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield group


class Coder(dict):
    """Ids of slices as little-endian unsigned 32-bit bytes, merged on demand, and back."""

    def __init__(self, path):
        self.ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.decimals = [str(i) for i in range(len(self.tokens))]

    def __missing__(self, part):
        raw = part.encode()
        ids = np.array(self.merge(raw), "<u4").tobytes()
        if len(part) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[part] = ids
        return ids

    def merge(self, raw):
        """Ids of a slice: the pair of lowest rank merges first, the leftmost of equals."""
        known = self.ranks.get(raw)
        if known is not None:
            return [known]
        parts = self._merge_short(raw) if len(raw) <= SHORT else self._merge_long(raw)
        return [self.ranks[p] for p in parts]

    def _merge_short(self, raw):
        parts = [raw[i : i + 1] for i in range(len(raw))]
        rank, none = self.ranks.get, 1 << 40
        pairs = [rank(raw[i : i + 2], none) for i in range(len(raw) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            merged = parts[i] = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(merged + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + merged, none)
        return parts

    def _merge_long(self, raw):
        """The same with a heap of pairs over linked parts: n log n steps for n bytes."""
        n = len(raw)
        end = list(range(1, n + 1))  # where the part that starts here ends; 0: merged away
        before = list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = end[i]
            if j < n:
                rank = self.ranks.get(raw[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, j, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or end[j] != k:
                continue  # one of the two has merged meanwhile
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        parts, i = [], 0
        while i < n:
            parts.append(raw[i : end[i]])
            i = end[i]
        return parts

    def encode(self, parts):
        """Ids of a text's slices."""
        return np.frombuffer(b"".join(map(self.__getitem__, parts)), "<u4")

    def decode(self, ids):
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def offsets(self, ids):
        """Byte at which each id begins in the UTF-8 form of its text."""
        lengths = self.lengths[ids]
        return np.cumsum(lengths) - lengths


_coders = {}


def coder_of(path):
    """The coder of a worker process: tasks that follow each other find its slices known."""
    if path not in _coders:
        _coders.clear()
        _coders[path] = Coder(path)
    return _coders[path]


def default_vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _mapped(docs, columns, schema, row):
    """mapInPandas over the rows of `docs`; `row` turns a list of texts into a list of tuples."""

    def run(frames):
        work = row()
        for f in frames:
            ids, texts = f.iloc[:, 0], ["" if t is None else t for t in f.iloc[:, 1]]
            at = 0
            for group in batches(texts):
                done = work(group)
                yield pd.DataFrame(
                    [(None if pd.isna(i) else i, *r) for i, r in zip(ids.iloc[at : at + len(group)], done)],
                    columns=columns,
                )
                at += len(group)

    return docs.mapInPandas(run, schema)


def encode_documents(docs, vocabulary=None, row_id="doc_id", text="text"):
    """`doc_id`, `ids` (array of int), `offsets` (array of bigint: the byte of the UTF-8 text at
    which each id begins) for every row of `docs`. A null text is empty and has no ids. Rows
    with a null or repeated id are encoded each; other columns are ignored."""
    path = vocabulary or default_vocabulary()

    def row():
        coder = coder_of(path)

        def work(texts):
            out = []
            for parts in slices(texts):
                ids = coder.encode(parts)
                out.append((ids.astype(np.int32), coder.offsets(ids)))
            return out

        return work

    source = docs.select(F.col(row_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return _mapped(source, ["doc_id", "ids", "offsets"], "doc_id bigint, ids array<int>, offsets array<bigint>", row)


def decode_documents(encoded, vocabulary=None):
    """`doc_id` and `decoded` (the bytes of the ids, joined) for rows of (doc_id, ids)."""
    path = vocabulary or default_vocabulary()

    def run(frames):
        coder = coder_of(path)
        for f in frames:
            done = [coder.decode(np.asarray(ids, np.int64)) for ids in f["ids"]]
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "decoded": done})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id bigint, decoded binary")


def digest_documents(docs, vocabulary=None, row_id="doc_id", text="text"):
    """Encodes and decodes every row in one pass: `doc_id`, `n_tokens`, `ids_sha256` (of the
    decimal ids joined by one space), `decoded_sha256` (of the decoded bytes). Rows as in
    `encode_documents`."""
    path = vocabulary or default_vocabulary()

    def row():
        coder = coder_of(path)

        def work(texts):
            out = []
            for parts in slices(texts):
                ids = coder.encode(parts)
                told = " ".join(map(coder.decimals.__getitem__, ids.tolist())).encode()
                out.append((len(ids), hashlib.sha256(told).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()))
            return out

        return work

    source = docs.select(F.col(row_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return _mapped(source, columns, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", row)
