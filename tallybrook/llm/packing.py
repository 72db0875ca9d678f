"""Packing tokenised documents into fixed windows by non-negative least squares.

1. Tasks tokenise whole texts, cut every document into full windows and one rest, and number
   the rests of each length within the task. The pieces, ids included, are written down once.
2. Only the histogram of rest lengths (fewer bins than the window has tokens) reaches the
   driver. Combinations of up to three lengths that fill a window are enumerated on a grid, the
   repeat counts that best explain the histogram are solved for by non-negative least squares,
   rounded down, and the residual counts are packed greedily, longest first, on the histogram.
3. Counts per task and length turn the number within the task into a rank within the length,
   and the rank finds its sequence and offset in the plan, whose size depends on the window
   alone.
"""

import os
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stage

# Fixed values.
WINDOW = 2048
END_ID = 1
GRID = 8  # lengths are rounded up to this for the combinations; they keep their own length
CACHE, CORES = 400_000, 800_000  # words and words without signs whose ids a worker remembers
LONGEST = 48  # longer ones are tokenised again each time
BLOCK = 4096  # words given to the tokenizer at once
SIGNS = ".,;:!?*$#%&"  # at the end of a word
WORD_END = "</w>"  # at the end of tokens that end a word
FOLDED = "\u0130"  # letters before it have one lower-case letter, wherever they stand

PIECES = (
    "doc_id bigint, start bigint, length int, doc_tokens bigint, ids binary,"
    " part int, nth bigint"
)


class WordIds:
    """Ids of space-free words as little-endian unsigned 32-bit bytes, tokenised on demand.

    The tokenizer turns white space into one space, drops it before the merges and divides
    letters from other signs, so a text's ids are those of its words in order, and a word's are
    those of the word without the signs at its end and of these signs. Both are remembered,
    the former longer, as most new words are known ones with other signs. New words of letters
    go to the tokenizer in one text, as only the last id of each ends a word.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.ids, self.cores, self.long = {}, {"": b""}, []

    def learn(self, words):
        """Makes the ids of the set `words` known until the next call."""
        for w in self.long:
            self.ids.pop(w, None)
        new = words.difference(self.ids)
        if len(self.ids) + len(new) > CACHE:
            self.ids.clear()
            new = words
        if len(self.cores) > CORES:
            self.cores = {"": b""}
        self.long = [w for w in new if len(w) > LONGEST]
        cores, ids, parts, letters, others = self.cores, self.ids, [], {}, {}
        for w in new:
            core = w.rstrip(SIGNS)
            simple = core.isalpha()
            if not core[-1:].isalpha() or core[-1] >= FOLDED:
                core, simple = w, False
            end = w[len(core) :]
            if "<" not in core and (core.isascii() or max(core) < FOLDED):
                core = core.lower()
            else:
                simple = False
            if core in cores and end in cores:
                ids[w] = cores[core] + cores[end]
                continue
            parts.append((w, core, end))
            if core not in cores:
                (letters if simple else others)[core] = None
            if end not in cores:
                others[end] = None
        self._encode_letters(list(letters), others)
        self._encode(list(others))
        for w, core, end in parts:
            ids[w] = cores[core] + cores[end]
        for unknown in (letters, others):
            for part in unknown:
                if len(part) > LONGEST:
                    cores.pop(part, None)

    def _encode(self, parts):
        for at in range(0, len(parts), BLOCK):
            block = parts[at : at + BLOCK]
            for part, e in zip(block, self.tokenizer.encode_batch_fast(block, add_special_tokens=False)):
                self.cores[part] = np.asarray(e.ids, "<u4").tobytes()

    def _encode_letters(self, parts, others):
        """Words of letters, in one text; to `others` if their ends are not to be seen in it."""
        for at in range(0, len(parts), BLOCK):
            block = parts[at : at + BLOCK]
            encoded = self.tokenizer.encode_batch_fast([" ".join(block)], add_special_tokens=False)
            found = np.asarray(encoded[0].ids, "<u4")
            stops = (4 * (np.flatnonzero(self.ends[found]) + 1)).tolist()
            whole = found.tobytes()
            if len(stops) == len(block) and stops[-1] == len(whole):
                self.cores.update(zip(block, [whole[i:j] for i, j in zip([0, *stops], stops)]))
            else:
                others.update(dict.fromkeys(block))


_known = {}


def known_words(path):
    """The words that a worker process has met, whatever task it met them in."""
    if path not in _known:
        _known.clear()
        _known[path] = WordIds(path)
    return _known[path]


def default_tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut_pieces(docs, tokenizer=None, row_id="doc_id", text="text", window=WINDOW):
    """Pieces of every row of `docs`: full windows, then the rest. A null text is empty and
    leaves one piece with the end id alone. Rows are handled one at a time, so memory is
    bounded by one text. `ids` holds little-endian unsigned 32-bit ids."""
    path = tokenizer or default_tokenizer()
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches):
        known, part, nth = known_words(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            out = []
            for doc_id, t in zip(batch[0], batch[1]):
                words = (t or "").replace("\n", " ").split(" ")
                known.learn(set(words))
                ids = b"".join(map(known.ids.__getitem__, words)) + end
                n = len(ids) // 4
                for at in range(0, n, window):
                    piece = ids[4 * at : 4 * (at + window)]
                    size = len(piece) // 4
                    out.append((doc_id, at, size, n, piece, part, nth[size]))
                    nth[size] += 1
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "doc_tokens", "ids", "part", "nth"])

    def batches(frames):
        return run((f.iloc[:, 0], f.iloc[:, 1]) for f in frames)

    return docs.select(F.col(row_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(batches, PIECES)


def solve_nnls(members, target, rounds=3000):
    """min |A x - target|, x >= 0, for columns given by their member rows (0/1/2/3 counts).

    Accelerated projected gradient on the sparse columns; starts from zero.
    """
    rows, n = np.asarray(members), len(target)
    x = y = np.zeros(len(rows))
    t, step = 1.0, 1.0 / max(1.0, 3.0 * np.bincount(rows.ravel(), minlength=n + 1).max())
    for _ in range(rounds):
        fitted = np.bincount(rows.ravel(), np.repeat(y, rows.shape[1]), minlength=n + 1)[:n]
        miss = np.append(target - fitted, 0.0)
        new = np.maximum(0.0, y + step * miss[rows].sum(axis=1))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def combinations(histogram, window=WINDOW, grid=GRID):
    """Triples of grid cells (0 = none) that fill the window, among cells that hold lengths."""
    full = window // grid
    cells = sorted({-(-size // grid) for size, n in histogram.items() if n})
    have = set(cells)
    found = set()
    for a in cells:
        if a == full:
            found.add((a, 0, 0))
        if full - a in have:
            found.add(tuple(sorted((a, full - a), reverse=True)) + (0,))
        for b in cells:
            c = full - a - b
            if c in have:
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found, reverse=True)


def plan_sequences(histogram, window=WINDOW, grid=GRID):
    """Rows (length, first rank, count, repeats, first sequence, offset) that place all ranks.

    Ranks first .. first+count-1 of a length go `repeats` to a sequence, side by side from
    `offset`. Returns the rows and the number of sequences.
    """
    histogram = {int(k): int(v) for k, v in histogram.items() if v}
    left, used, rows, sequences = dict(histogram), defaultdict(int), [], 0

    def place(parts, count, base):
        at = 0
        for size, repeats in parts:
            rows.append((size, used[size], count * repeats, repeats, base, at))
            used[size] += count * repeats
            at += size * repeats

    combos = combinations(histogram, window, grid)
    if combos:
        cells = defaultdict(list)
        for size in sorted(histogram, reverse=True):
            cells[-(-size // grid)].append(size)
        n = window // grid + 1
        target = np.zeros(n)
        for cell, sizes in cells.items():
            target[cell] = sum(histogram[s] for s in sizes)
        members = np.where(np.asarray(combos) == 0, n, np.asarray(combos))
        scale = max(1.0, target.max())
        counts = np.floor(solve_nnls(members, target / scale) * scale + 1e-6).astype(int)
        for combo, count in sorted(zip(combos, counts), key=lambda p: -p[1]):
            while count > 0:
                # real lengths of the cells, as many as all of them still have
                picked, need = [], defaultdict(int)
                for cell in (c for c in combo if c):
                    size = next((s for s in cells[cell] if left[s] > need.get(s, 0)), None)
                    if size is None:
                        break
                    need[size] += 1
                    picked.append(size)
                else:
                    times = min([count] + [left[s] // k for s, k in need.items()])
                    place([(s, 1) for s in picked], times, sequences)
                    for s, k in need.items():
                        left[s] -= k * times
                    sequences += times
                    count -= times
                    continue
                break
    # residuals: longest first into the fullest window with room, whole histogram bins at once
    room = defaultdict(list)  # free tokens -> [(count, parts)]
    for size in sorted((s for s, n in left.items() if n), reverse=True):
        n = left[size]
        while n:
            free = min((f for f in room if f >= size), default=None)
            if free is None:
                fit = window // size
                if n >= fit:
                    room_for, repeats = n // fit, fit
                else:
                    room_for, repeats = 1, n
                parts = [(size, repeats)]
                room_left = window - size * repeats
                n -= room_for * repeats
                room[room_left].append((room_for, parts))
                continue
            count, parts = room[free].pop()
            repeats = min(free // size, n)
            times = min(count, n // repeats)
            if count > times:
                room[free].append((count - times, parts))
            if not room[free]:
                del room[free]
            room[free - size * repeats].append((times, parts + [(size, repeats)]))
            n -= times * repeats
    for free in sorted(room):
        for count, parts in room[free]:
            place(parts, count, sequences)
            sequences += count
    return rows, sequences


def place_pieces(spark, pieces, window=WINDOW):
    """Adds `sequence_id` and `offset` to the written `pieces` (without their ids)."""
    d = pieces.drop("ids")
    counts = stage(spark, d.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan_sequences(histogram, window)
    rows.sort()
    plan = np.asarray(rows, dtype=np.int64).reshape(-1, 6)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        # plan rows are ordered by (length, first rank): the last one not after the piece holds it
        keys = plan[:, 0].astype(np.float64) * 2.0**40 + plan[:, 1]
        at = np.searchsorted(keys, length.to_numpy(np.float64) * 2.0**40 + rank.to_numpy(np.int64), "right") - 1
        row = plan[at]
        i = rank.to_numpy(np.int64) - row[:, 1]
        return pd.DataFrame(
            {"sequence_id": row[:, 4] + i // row[:, 3], "offset": row[:, 5] + i % row[:, 3] * row[:, 0]}
        )

    ranked = d.join(starts, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    return ranked.withColumn("at", find("length", "rank")).select(*d.columns, "at.sequence_id", "at.offset")


def pack_documents(spark, docs, tokenizer=None, row_id="doc_id", text="text", window=WINDOW):
    """Pieces with their ids and places: `doc_id`, `start`, `length`, `doc_tokens`, `ids`,
    `ids_crc32`, `sequence_id`, `offset`.

    Every id of every row lies in exactly one piece; the pieces of a sequence are gapless from
    0. Null and empty texts have the end id alone. Repeated rows and rows with the same or a
    null id are packed each. An empty table gives no pieces. Other columns are ignored.
    """
    cut = cut_pieces(docs, tokenizer, row_id, text, window).withColumn("ids_crc32", F.crc32("ids"))
    pieces = stage(spark, cut, "pack-pieces")
    return pieces, place_pieces(spark, pieces, window)


def read_sequences(pieces, placed):
    """The sequences with their ids: `sequence_id`, `length`, `ids` (binary, unpadded)."""
    both = placed.select("part", "length", "nth", "sequence_id", "offset").join(
        pieces.select("part", "length", "nth", "ids"), ["part", "length", "nth"]
    )
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return both.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("h")
    ).select("sequence_id", "length", F.unhex("h").alias("ids"))
