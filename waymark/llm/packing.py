"""Packing: bounded-space online best fit.

Every partition keeps a fixed number of open windows.  A document's tokens and its end token are cut into whole
windows; the rest goes to the open window where it leaves least room; where none has room, the fullest is emitted and
a new one opened.  The pieces are written to the checkpoint folder; those of windows that were still open when their
partition ended go to a second pass, which merges the leftovers of `merge_factor` partitions by best fit in decreasing
order.  Only these are shuffled.  Tasks hold windows' fill levels and pieces, never texts.

`Words` gives the ids of the public tokenizer: it splits at white space and looks each chunk up in a bounded cache;
chunks of ASCII and Latin-1 letters that are new are encoded by byte pairs, others by `tokenizers` itself, whose Unicode
tables aren't Python's.  Texts that hold a special token's string go through `tokenizers` whole.

Defined results: a null or empty text is its end token alone; every input row is packed, repeated rows too; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymark.llm.common import as_documents, partitions, runs, stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SEPARATORS = regex.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the tokenizer does not
SPACE = regex.compile(r"\s+")
LATIN = regex.compile("[!-~À-ÖØ-öø-ÿ]+")  # ASCII and the letters of Latin-1, whose normal form and lower case are the same in all tables
LONG = 100  # characters of a chunk above which it is not kept


class Words:
    """Token ids of texts, as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str, cached: int = 600_000) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.parts = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        letters = self._letters()
        suffix, vocabulary, ranks = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"], {}
        for token, i in sorted(vocabulary.items(), key=lambda x: x[1]):
            if token not in self.special:
                plain = token.removesuffix(suffix)
                raw = bytes(letters[c] for c in plain) + (b"\xff" if plain != token else b"")
                ranks[raw] = i
        #: The end of a word is the byte 0xff, which UTF-8 never has.  Its pairs with single bytes come before all merges.
        order = sorted(ranks, key=lambda raw: (len(raw) > 1, len(raw) > 2 or raw[-1:] != b"\xff", ranks[raw]))
        order = [bytes([b]) for b in range(256) if bytes([b]) not in ranks] + order
        order.sort(key=lambda raw: len(raw) > 1)
        self.ids = [ranks.get(raw, 0).to_bytes(4, "little") for raw in order]
        self.pairs = tiktoken.Encoding("words", pat_str=r".", mergeable_ranks={raw: i for i, raw in enumerate(order)}, special_tokens={})._core_bpe
        self.cached, self.cache = cached, {}

    @staticmethod
    def _letters() -> dict[str, int]:
        """The byte that each character of a byte-level vocabulary stands for."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def whole(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def chunk(self, text: str) -> bytes:
        """Ids of a text without white space."""
        if not text.isascii() and not LATIN.fullmatch(text):
            return self.whole(text)
        lowered = text.lower()
        parts = [lowered] if lowered.isalpha() else self.parts.findall(lowered)
        piece, ids = self.pairs.encode_single_piece, self.ids
        return b"".join([ids[i] for part in parts for i in piece(part.encode() + b"\xff")])

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self.whole(text)
        chunks, cache = SPACE.split(text) if SEPARATORS.search(text) else text.split(), self.cache
        try:
            return b"".join([cache[c] for c in chunks])
        except KeyError:
            if len(cache) > self.cached:
                cache.clear()
            long = {}
            for c in chunks:
                if c not in cache:
                    (cache if len(c) <= LONG else long)[c] = self.chunk(c)
            return b"".join([cache[c] if c in cache else long[c] for c in chunks])


class Windows:
    """At most `most` open windows; a window is its fill and its pieces."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most = size, most
        self.rooms: list[tuple[int, int]] = []  # (room, number), sorted
        self.pieces: dict[int, list] = {}
        self.made = 0

    def new(self) -> int:
        self.made += 1
        self.pieces[self.made - 1] = []
        return self.made - 1

    def place(self, length: int, pieces: list) -> list[tuple[int, list]]:
        """Puts pieces of `length` tokens in all into one window; returns the windows that this closes."""
        closed = []
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, number = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.most:
                number = self.rooms.pop(0)[1]
                closed.append((number, self.pieces.pop(number)))
            room, number = self.size, self.new()
        offset = self.size - room
        for piece, n in pieces:
            self.pieces[number].append((piece, offset))
            offset += n
        if room > length:
            insort(self.rooms, (room - length, number))
        else:
            closed.append((number, self.pieces.pop(number)))
        return closed

    def rest(self) -> list[tuple[int, list]]:
        self.rooms.clear()
        out, self.pieces = sorted(self.pieces.items()), {}
        return out


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, open_windows: int = 64, merge_factor: int = 8) -> DataFrame:
    """The pieces of all documents, in the columns of PIECES; sequence_id numbers windows, with gaps."""
    end = end_id.to_bytes(4, "little")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, windows, part = Words(tokenizer), Windows(window, open_windows), TaskContext.get().partitionId()
        rows: list[tuple] = []

        def out(closed: list, leftover: bool) -> None:
            for number, pieces in closed:
                for piece, offset in pieces:
                    rows.append((*piece, part << 32 | number, offset, leftover))

        for batch in runs(batches, 4 << 20):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = memoryview(words.encode(text or "") + end)
                total = len(ids) // 4
                for start in range(0, total, window):
                    cut = ids[4 * start : 4 * (start + window)]
                    n = len(cut) // 4
                    out(windows.place(n, [((doc_id, start, n, zlib.crc32(cut), total), n)]), False)
            yield frame(rows)
            rows.clear()
        out(windows.rest(), True)
        yield frame(rows)

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if i == 7 else pa.int64()) for i, c in enumerate(columns)], [*names, "leftover"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}

        def merged() -> pa.RecordBatch:
            windows, rows = Windows(window, max(1, len(held))), []
            sized = sorted(((sum(p[2] for p in pieces), number) for number, pieces in held.items()), key=lambda x: (-x[0], x[1]))
            closed = []
            for total, number in sized:
                closed += windows.place(total, [(p, p[2]) for p in held[number]])
            for number, pieces in [*closed, *windows.rest()]:
                rows += [(*piece[:5], 1 << 62 | group << 32 | number, offset, False) for piece, offset in pieces]
            held.clear()
            return frame(rows).select(names)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                key = (row[5] >> 32) // merge_factor
                if key != group:
                    yield merged()
                    group = key
                held.setdefault(row[5], []).append(row)
        yield merged()

    names = [x.split()[0] for x in PIECES.split(", ")]
    pieces = stored(as_documents(docs).mapInArrow(first, f"{PIECES}, leftover boolean"))
    group = F.floor(F.shiftright("sequence_id", 32) / merge_factor)
    dealt = pieces.where("leftover").select(names).repartition(partitions(docs.sparkSession), group).sortWithinPartitions("sequence_id", "offset")
    return pieces.where("NOT leftover").select(names).unionByName(dealt.mapInArrow(second, PIECES))
