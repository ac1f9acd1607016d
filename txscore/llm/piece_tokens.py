"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A model file gives pieces and scores. Texts are cut into units at spaces, line breaks and
between letters and other characters, where no piece of the model crosses (checked when it
is loaded); units are encoded once per task and kept in bounded tables. All units still missing are encoded together: their symbols lie in
one flat array, each round looks up the rank of every adjacent pair, takes the smallest
rank of each unit (a segmented minimum), merges the leftmost pairs of that rank at the
same time, and compacts the arrays. Units with no pair left drop out.

All pairs of the smallest rank may merge in one round if the merged piece takes
part in better pairs nowhere; otherwise only the leftmost one does. That makes the rounds
equal to the sequential merge order. Runs of spaces are one unit: their pieces have the
lowest score of all, so they merge after everything else, leftmost first.

A unit of over ``LONG`` characters (text without spaces) goes through the same rounds with a
two-level minimum: it lies in blocks that hold their smallest rank, a round reads and
renews only the blocks with the smallest of all, and the array is compacted when half of
it is merged away.

Characters without a piece become byte pieces. Null text counts as empty; empty text has
no ids. Repeated rows are encoded each; a null id is carried along.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require, slices

SPACE = "▁"
LETTER, DIGIT = r"[^\W\d_¹²³¼½¾]", r"[\d_¹²³¼½¾]"
UNITS = re.compile(rf" ?{LETTER}+| ?(?:[^\w \n]|{DIGIT})+|\n| ")
#: Units in a table of a task. Two tables are kept: when the newer is full, it becomes the older.
KEPT_UNITS = 150_000
#: Characters of the units in a table of a task.
KEPT_CHARS = 8 << 20
#: Units, and characters, that go through the merge rounds together.
ROUND_UNITS = 8192
ROUND_CHARS = 1 << 19
#: Characters from which on a unit has rounds of its own, and symbols in its blocks.
LONG = 4096
BLOCK = 256
NO_RANK = np.int64(1) << 40


class PieceModel:
    """Tables of a BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = [sp.is_unknown(i) or sp.is_control(i) for i in range(size)]
        self.bytes = np.full(256, -1, np.int64)
        self.surface: list[str | int] = []  # text of an id; an int for a byte piece
        piece_id: dict[str, int] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[value] = i
                self.surface.append(value)
            else:
                self.surface.append(" ⁇ " if sp.is_unknown(i) else "" if special[i]
                                    else piece.replace(SPACE, " "))
                if not special[i]:
                    piece_id[piece] = i
        self.byte_ids = frozenset(self.bytes.tolist())
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte fallback")
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in piece_id if len(p) > 1):
            raise ValueError("the model has pieces that cross spaces or line breaks")
        mixed = re.compile(rf"{LETTER}(?:{DIGIT}|[^\w{SPACE}])|(?:{DIGIT}|[^\w{SPACE}]){LETTER}")
        if any(mixed.search(p) for p in piece_id):
            raise ValueError("the model has pieces of letters and other characters")
        self.plain = set(piece_id.values())
        # symbols: piece ids, then characters that only occur inside pieces
        self.symbol = dict(piece_id)
        for p in piece_id:
            for c in p:
                self.symbol.setdefault(c, size + len(self.symbol))
        # characters of no piece: negative symbols, which no pair has
        self.of_char = -1 - np.arange(0x110000, dtype=np.int64)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.inner = {i: c for c, i in self.symbol.items() if i >= size}
        scores = {i: sp.get_score(i) for i in piece_id.values()}
        rank_of = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = []
        for p, i in piece_id.items():
            for cut in range(1, len(p)):
                left, right = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, rank_of[scores[i]], i))
        pairs.sort()
        self.keys = np.array([p[0] for p in pairs], np.int64)
        self.ranks = np.array([p[1] for p in pairs], np.int64)
        self.merged = np.array([p[2] for p in pairs], np.int64)
        # a merge is safe if no pair with its piece has as good a rank
        best = np.full(max(self.symbol.values()) + 1, NO_RANK)
        for side in (self.keys >> 32, self.keys & 0xFFFFFFFF):
            np.minimum.at(best, side, self.ranks)
        self.safe = best[self.merged] > self.ranks
        runs = {len(p): i for p, i in piece_id.items() if set(p) == {SPACE}}
        worst = {scores[i] for n, i in runs.items() if n > 1}
        self.longest_run = top = max(runs)
        self.runs = [leftmost_run(n, runs) for n in range(2 * top)]
        self.space = runs[1]
        if (len(worst) > 1 or worst and worst != {min(scores.values())}
                or any(self.runs[top + n] != [runs[top], *self.runs[n]] for n in range(top))
                or any(p.count(SPACE) > 1 and set(p) != {SPACE} for p in piece_id)):
            raise ValueError("runs of spaces don't merge last and leftmost in this model")

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit (no unit holds two adjacent spaces)."""
        short = [u if len(u) <= LONG else "" for u in units]
        parts, owners = self.merge_rounds(short)
        for i, u in enumerate(units):
            if len(u) > LONG:
                parts.append(self.merge_long(u))
                owners.append(np.full(len(parts[-1]), i))
        if not parts:
            return [[] for _ in units]
        symbols, unit = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(unit, kind="stable")
        symbols, ends = symbols[order], np.searchsorted(unit[order], np.arange(len(units) + 1))
        size, flat = len(self.surface), symbols.tolist()
        odd = np.flatnonzero((symbols < 0) | (symbols >= size))
        for i in odd.tolist():
            c = self.inner[flat[i]] if flat[i] >= 0 else chr(-1 - flat[i])
            flat[i] = self.bytes[list(c.encode())].tolist()
        ends = ends.tolist()
        out = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        unit = unit[order]
        for u in set(unit[odd].tolist()):
            out[u] = [y for x in out[u] for y in (x if isinstance(x, list) else (x,))]
        return out

    def characters(self, text: str) -> np.ndarray:
        return self.of_char[np.frombuffer(text.replace(" ", SPACE).encode("utf-32-le"), np.uint32)]

    def merge_rounds(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Final symbols of the units, and the unit of each, in parts."""
        lengths = np.array([len(u) for u in units], np.int64)
        symbols = self.characters("".join(units))
        unit = np.repeat(np.arange(len(units)), lengths)
        done_symbols, done_units = [], []
        rank, at = self.look_up(symbols, unit, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            over = least == NO_RANK
            if over.any():  # compaction: units with no pair left
                keep = np.repeat(~over, sizes)
                done_symbols.append(symbols[~keep])
                done_units.append(unit[~keep])
                symbols, unit, rank, at = symbols[keep], unit[keep], rank[keep], at[keep]
                sizes, least = sizes[~over], least[~over]
                if not len(symbols):
                    break
            spots = np.flatnonzero(rank == np.repeat(least, sizes))
            # in a row of touching pairs every second one merges, from the left
            fresh = np.append(True, np.diff(spots) > 1)
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(spots)), 0))
            take = (np.arange(len(spots)) - first) % 2 == 0
            lead = np.append(True, unit[spots][1:] != unit[spots][:-1])
            spots = spots[take & (self.safe[at[spots]] | lead)]
            symbols[spots] = self.merged[at[spots]]
            keep = np.ones(len(symbols), bool)
            keep[spots + 1] = False
            symbols, unit, rank, at = symbols[keep], unit[keep], rank[keep], at[keep]
            # only the pairs that hold a merged symbol are new
            spots -= np.arange(len(spots))
            new = np.concatenate([spots, np.maximum(spots - 1, 0)])
            rank[new], at[new] = self.look_up(symbols, unit, new)
        return done_symbols, done_units

    def merge_long(self, word: str) -> np.ndarray:
        """Final symbols of one long unit."""
        symbols = self.characters(word)
        while True:
            # places 0 and n + 1 are ends; ``after`` and ``prior`` skip what is merged away
            n = len(symbols)
            rows = -(-(n + 2) // BLOCK)
            flat = np.full(rows * BLOCK, -1, np.int64)
            flat[1:n + 1] = symbols
            after, prior = np.arange(1, len(flat) + 1), np.arange(-1, len(flat) - 1)
            rank, at = np.full(len(flat), NO_RANK), np.zeros(len(flat), np.int64)
            rank[:n + 1], at[:n + 1] = self.pair_ranks(flat[:n + 1], flat[1:n + 2])
            by_block = rank.reshape(rows, BLOCK)
            live = np.zeros(len(flat), bool)
            live[1:n + 1] = True
            least, alive = by_block.min(axis=1), n
            while alive > n // 2:
                best = least.min()
                if best == NO_RANK:
                    break
                blocks = np.flatnonzero(least == best)
                row, column = np.nonzero(by_block[blocks] == best)
                spots = blocks[row] * BLOCK + column
                # in a row of touching pairs every second one merges, from the left
                fresh = np.append(True, spots[1:] != after[spots[:-1]])
                first = np.maximum.accumulate(np.where(fresh, np.arange(len(spots)), 0))
                take = (np.arange(len(spots)) - first) % 2 == 0
                spots = spots[take]
                gone, made = after[spots], self.merged[at[spots]]
                if not self.safe[at[spots]].all():  # up to the first that makes as good a pair
                    left = flat[prior[spots]]
                    beside = np.flatnonzero(prior[spots[1:]] == gone[:-1])
                    left[beside + 1] = made[beside]
                    better = np.minimum(self.pair_ranks(left, made)[0],
                                        self.pair_ranks(made, flat[after[gone]])[0]) <= best
                    if better.any():
                        upto = int(better.argmax()) + 1
                        spots, gone, made = spots[:upto], gone[:upto], made[:upto]
                flat[spots], live[gone] = made, False
                after[spots] = after[gone]
                prior[after[gone]] = spots
                rank[gone] = NO_RANK
                new = np.concatenate([spots, prior[spots]])
                rank[new], at[new] = self.pair_ranks(flat[new], flat[after[new]])
                touched = np.unique(np.concatenate([new, gone]) // BLOCK)
                least[touched] = by_block[touched].min(axis=1)
                alive -= len(spots)
            symbols = flat[live]
            if best == NO_RANK:
                return symbols

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank, and place in the pair table, of pairs of symbols."""
        keys = np.where((left >= 0) & (right >= 0), left << 32 | right, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK), at

    def look_up(self, symbols: np.ndarray, unit: np.ndarray,
                spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank, and place in the pair table, of the pairs that begin at ``spots``."""
        after = np.minimum(spots + 1, len(symbols) - 1)
        left, right = symbols[spots], symbols[after]
        return self.pair_ranks(left, np.where((unit[spots] == unit[after]) & (spots < after), right, -1))

    def decode(self, ids: list[int], first: bool = True) -> str:
        """Text of ids; ``first``: they begin a text, so the dummy prefix goes."""
        surface = self.surface
        out = [surface[i] for i in ids]
        if not self.byte_ids.isdisjoint(ids):
            runs = itertools.groupby(out, lambda s: isinstance(s, int))
            out = [decode_bytes(bytearray(run)) if raw else "".join(run) for raw, run in runs]
        text = "".join(out)
        prefixed = first and ids and ids[0] in self.plain and surface[ids[0]][:1] == " "
        return text[1:] if prefixed else text


def leftmost_run(n: int, runs: dict[int, int]) -> list[int]:
    """Ids of a run of ``n`` spaces: its leftmost pair that is a piece merges, again and again."""
    parts = [1] * n
    while True:
        at = next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in runs), None)
        if at is None:
            return [runs[p] for p in parts]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def decode_bytes(held: bytearray) -> str:
    """UTF-8, with one replacement character for each byte that is not part of a character."""
    try:
        return held.decode()
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(held):
        for n in (1, 2, 3, 4):
            try:
                out.append(held[i:i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


class Encoder:
    """Encodes whole texts, unit by unit, with bounded tables of units."""

    def __init__(self, model: PieceModel, kept: int = KEPT_UNITS):
        self.model, self.kept = model, kept
        self.new: dict[str, bytes] = {}  # ids as native 32-bit integers
        self.old: dict[str, bytes] = {}
        self.chars = 0  # of the units in ``new``
        self.odd: set[str] = set()  # units that their ids don't decode to
        self.run_ids = {n: np.array(ids, np.int32).tobytes() for n, ids in enumerate(model.runs)}

    def learn(self, missing: list[str]) -> None:
        decode = self.model.decode
        sizes = np.cumsum([len(u) for u in missing])
        cuts = [0]
        while cuts[-1] < len(missing):  # at least one unit in each part
            i = cuts[-1]
            full = int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + ROUND_CHARS, "right"))
            cuts.append(max(i + 1, min(full, i + ROUND_UNITS)))
        for i, j in itertools.pairwise(cuts):
            part = missing[i:j]
            found = self.model.encode_units(part)
            self.new.update(zip(part, [np.array(x, np.int32).tobytes() for x in found], strict=True))
            self.odd.update([u for u, x in zip(part, found, strict=True) if decode(x, False) != u])

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids of each text (as 32-bit integers), and the text that these ids decode to."""
        plain = [" " + t.replace(SPACE, " ") if t else "" for t in texts]
        cut = [UNITS.findall(t) for t in plain]
        held = set().union(*cut)
        missing = held - self.new.keys()
        self.chars += sum(map(len, missing))
        if missing and (len(self.new) + len(missing) > self.kept or self.chars > KEPT_CHARS):
            self.old, self.new, missing = self.new, {}, held
            self.odd &= self.old.keys()
            self.chars = sum(map(len, held))
        known = missing & self.old.keys()
        self.new.update([(u, self.old[u]) for u in known])
        self.learn(sorted(missing - known))
        ids_of, out, decoded = self.new.__getitem__, [], []
        usual = self.odd.isdisjoint(held)
        for text, units in zip(plain, cut, strict=True):
            spaced = "  " in text or " \n" in text or text.endswith(" ")
            ids = self.spaced(units) if spaced else b"".join(map(ids_of, units))
            out.append(ids)
            if spaced or not usual:
                decoded.append(self.model.decode(np.frombuffer(ids, np.int32).tolist()))
            else:  # every unit's ids were decoded when it was learnt, and gave the unit
                decoded.append(text[1:])
        return out, decoded

    def spaced(self, units: list[str]) -> bytes:
        """Ids where single-space units stand for runs of spaces."""
        out: list[bytes] = []
        run, one, top = 0, np.int32(self.model.space).tobytes(), self.model.longest_run

        def close() -> None:
            nonlocal run
            whole, rest = divmod(run, top)
            out.append(self.run_ids[top] * whole + self.run_ids[rest])
            run = 0

        for u in units:
            if u == " ":
                run += 1
                continue
            own = self.new[u]
            if run and u[0] == " " and own[:4] == one:  # its space joins the run
                run, own = run + 1, own[4:]
            close()
            out.append(own)
        close()
        return b"".join(out)


def tokenize(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
             kept_units: int = KEPT_UNITS) -> DataFrame:
    """doc_id, ids (array of int), decoded (the text that these ids decode to)."""
    require(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(PieceModel(model), kept_units)
        for part in slices(batches, "text", 2 << 20):
            ids, decoded = encoder([t or "" for t in part.column("text").to_pylist()])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32) // 4
            flat = np.frombuffer(b"".join(ids), np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
