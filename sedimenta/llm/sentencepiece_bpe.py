"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Symbols start as characters. An agenda holds the adjacent pairs whose union is a piece, by score and
then from the left; the best is merged, its new neighbours join the agenda, and pairs that a merge has
made stale are passed over. A character without a piece falls back to its bytes.

No piece reaches over the start of a word, over a character that isn't in the vocabulary or between two characters that
stand together in no piece, so a text is cut at words, lines and the punctuation that ends a word, and each distinct
segment is encoded once per task. The library checks every new segment, and one whole text of each
Arrow batch.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.hashing import slices

#: Fixed value: the mark that stands for a space.
SPACE = "▁"
#: Segments a task remembers, some 250 bytes each; beyond that only those of the batch at hand stay.
CACHE_SEGMENTS = 1_000_000
#: Characters up to which the agenda of a segment is a plain list; the cost of a pair that is no piece.
SHORT, NEVER = 32, float("inf")
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]*")


class Vocabulary:
    """The pieces of a model file, and what they allow to assume about texts."""

    def __init__(self, path: str) -> None:
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(sp.get_piece_size())
        self.ids = {sp.id_to_piece(i): i for i in size if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.costs = {piece: -sp.get_score(i) for piece, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in size if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        sample = " a  bé①\t "
        if sp.normalize(sample) != SPACE + sample.replace(" ", SPACE):
            raise ValueError("only models without normalisation, with a prefix space, are supported")
        if any(sp.is_unused(i) for i in size):
            raise ValueError("models with unused pieces are not supported")
        known = {c for piece in self.ids for c in piece}
        self.neighbours = {piece[i:i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.by_word = not any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self.by_line = "\n" not in known
        self.segments: dict[str, tuple[int, ...]] = {}

    def encode_segment(self, text: str) -> list[int]:
        """Ids of a segment by the agenda of adjacent pairs."""
        return self._ids(self._merge_short(text) if len(text) <= SHORT else self._merge_long(text))

    def _merge_short(self, text: str) -> list[str]:
        """Symbols of a short segment: the agenda is the list of all pairs' costs, searched for its least."""
        symbols, costs = list(text), self.costs
        agenda = [costs.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := min(agenda)) < NEVER:
            i = agenda.index(best)
            symbols[i] = pair = symbols[i] + symbols[i + 1]
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = costs.get(pair + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = costs.get(symbols[i - 1] + pair, NEVER)
        return symbols

    def _merge_long(self, text: str) -> list[str]:
        """Symbols of a segment of any length: the agenda is a heap."""
        symbols, costs = list(text), self.costs
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(costs[pair], i, pair) for i in range(n - 1) if (pair := symbols[i] + symbols[i + 1]) in costs]
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            left = symbols[i]
            j = after[i]
            if not left or j >= n or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                joined = pair + symbols[k]
                if joined in costs:
                    heappush(agenda, (costs[joined], i, joined))
            h = before[i]
            if h >= 0:
                joined = symbols[h] + pair
                if joined in costs:
                    heappush(agenda, (costs[joined], h, joined))
        return [symbol for symbol in symbols if symbol]

    def _ids(self, symbols: list[str]) -> list[int]:
        known, out = self.ids, []
        for symbol in symbols:
            if symbol in known:
                out.append(known[symbol])
            elif self.bytes:
                out.extend(self.bytes[b] for b in symbol.encode())
            else:
                out.append(self.unknown)
        return out

    def cut(self, text: str) -> list[str]:
        """The segments of a text that is not empty, in order."""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return [marked]
        lines = marked.split("\n") if self.by_line else [marked]
        out = []
        for k, line in enumerate(lines):
            if k:
                out.append("\n")
            if SPACE + SPACE in line:
                out.extend(x for x in _RUNS.findall(line) if x)
            elif line:
                first, *rest = line.split(SPACE)
                if first:
                    out.append(first)
                for word in rest:
                    if word and word[-1] in string.punctuation:
                        head = word.rstrip(string.punctuation)
                        if head and head[-1] + word[len(head)] not in self.neighbours:
                            out.append(SPACE + head)
                            out.append(word[len(head):])
                            continue
                    out.append(SPACE + word)
        return out

    def check_segments(self, segments: list[str]) -> None:
        """Compare segments with the library, all in one text: each on a line of its own."""
        text = "".join("\n" + s.replace(SPACE, " ") for s in segments if s != "\n")
        want = [self.ids[SPACE], *chain.from_iterable((self.bytes[10], *self.segments[s]) for s in segments if s != "\n")]
        if self.by_line and self.bytes and text and self.library.encode(text) != want:
            raise ValueError("segments are encoded in another way by the sentencepiece library")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts; a repeated segment is encoded once."""
        cuts = [self.cut(t) if t else [] for t in texts]
        wanted = set(chain.from_iterable(cuts))
        if len(self.segments) > CACHE_SEGMENTS:  # those in use stay
            self.segments = {s: ids for s in wanted if (ids := self.segments.get(s)) is not None}
        known = self.segments
        fresh = list(wanted.difference(known))
        for segment in fresh:
            known[segment] = tuple(self.encode_segment(segment))
        self.check_segments(fresh)
        ids = [list(chain.from_iterable(map(known.__getitem__, c))) for c in cuts]
        if texts and self.library.encode(texts[0]) != ids[0]:
            raise ValueError("a text is encoded in another way by the sentencepiece library")
        return ids


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``keep``, ids and decoded.

    Without begin or end ids. A null text is an empty one and has no ids. Ids are hashed as decimals joined by
    commas, decoded texts (decode(ids) of the library) as UTF-8. Every row gives a row, repeated ones and null ids
    too; other columns are left out; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model_path)
        for batch in slices(batches):
            ids = words.encode([t or "" for t in batch.column("text").to_pylist()])
            back = words.library.decode(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(str(x)[1:-1].replace(" ", "").encode()).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back]),
                 pa.array(ids if keep else [None] * len(ids), pa.list_(pa.int32())), pa.array(back if keep else [None] * len(ids), pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string")
    return out if keep else out.drop("ids", "decoded")
