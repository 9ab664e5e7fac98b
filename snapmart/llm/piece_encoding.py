"""SentencePiece BPE encoding and decoding through a table of last tokens.

The greedy merges of BPE have one result for each text, and a token list is that result just
when each pair of neighbours is: merges of the whole text that stay inside a pair are the
merges of that pair alone, in the same order. So the last token of each prefix is unique: of
the pieces that end there (found by an automaton), the one that is compatible with the last
token of the prefix before it. The table of last tokens is filled from left to right and read
backwards for the ids. A pair is compatible if merging its text gives the pair again, which is
tested once and kept.

No piece of a usual model joins a letter to a following space mark, so the text is cut before
space marks and at line ends, which no piece holds, and short parts are kept with their ids.
Both facts are checked in the vocabulary; where they do not hold, the text stays whole.

The vocabulary file is a parameter, read on the driver (of known size) and sent to the tasks.
Supported: BPE models with byte fallback, an added first space and no other text changes; a
model that differs is refused by a round trip of probe texts.

Defined cases: a null text counts as empty; an empty text has no ids; texts of any length take
memory in proportion to the longest one; a null id passes through; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import table

SPACE = "▁"
#: Parts and token pairs that a Python worker remembers; past that it starts anew.
REMEMBERED = 150_000
REMEMBERED_CHARS = 40
REMEMBERED_PAIRS = 500_000


_tables: dict[int, PieceTable] = {}


def piece_table(model: bytes) -> PieceTable:
    """One table for all tasks of a Python worker: what it remembers depends on the model alone."""
    key = zlib.crc32(model)
    if key not in _tables:
        _tables.clear()
        _tables[key] = PieceTable(model)
    return _tables[key]


class PieceTable:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [own.id_to_piece(i) for i in range(own.vocab_size())]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if own.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback")
        self.control = {i for i in range(len(self.pieces)) if own.is_control(i) or own.is_unknown(i)}
        plain = [i for i in range(len(self.pieces)) if i not in self.byte_of and i not in self.control]
        self.id = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: own.get_score(i) for i in plain}
        for probe in ("", "a  b ", "ﬁ é\t\n　 A", "▁x \U0001d4b3"):
            if own.decode(own.encode(probe)) != probe.replace(SPACE, " "):
                raise ValueError("the model changes texts: only an added first space is supported")
        if own.encode("a") and not self.pieces[own.encode("a")[0]].startswith(SPACE):
            raise ValueError("the model adds no first space")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        cut = all("\n" not in p and SPACE not in p.lstrip(SPACE) for p in self.id)
        self.parts = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+" if cut else r"(?s).+")
        self.chars = len(self.pieces)
        self.lengths = [len(p) for p in self.pieces]
        if self.control and 0 not in self.control:
            raise ValueError("id 0 is a piece: it is meant to be the unknown token")
        #: For each piece, the tokens that it was tested after.
        self.follows: list[dict[int, bool]] = [{} for _ in self.pieces]
        self.n_pairs = 0
        self.known: dict[str, tuple[int, ...]] = {}

    def merged(self, text: str) -> list[str]:
        """Greedy merges of a short text: the best score first, then the leftmost."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = self.score.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether `right` may follow `left` (codes of tokens; 0 stands for the start of the text)."""
        known = self.follows[right].get(left)
        if known is None:
            self.n_pairs += 1
            if self.n_pairs > REMEMBERED_PAIRS:
                self.n_pairs = 1
                for held in self.follows:
                    held.clear()
            before, after = self.text_of(left), self.text_of(right)
            known = self.merged(before + after) == ([before, after] if before else [after])
            self.follows[right][left] = known
        return known

    def text_of(self, code: int) -> str:
        """Codes below `self.chars` are ids (the unknown id: nothing), others characters that are no piece."""
        return chr(code - self.chars) if code >= self.chars else self.pieces[code] if code else ""

    def part_ids(self, part: str) -> tuple[int, ...]:
        """Ids of one part: fill the table of last tokens, then walk it backwards."""
        lengths, follows, chars = self.lengths, self.follows, self.chars
        last = [0] * (len(part) + 1)
        for end, i in self.automaton.iter(part):  # by end, the longest piece first
            end += 1
            if last[end]:
                continue
            start = end - lengths[i]
            left = last[start]
            if not left and start:
                left = last[start] = chars + ord(part[start - 1])
            known = follows[i].get(left)
            if known or known is None and self.compatible(left, i):
                last[end] = i
        for end in range(1, len(last)):
            if not last[end]:
                last[end] = chars + ord(part[end - 1])
        ids: list[int] = []
        end = len(part)
        while end:
            code = last[end]
            if code >= chars:
                ids.extend(self.byte[b] for b in reversed(chr(code - chars).encode()))
                end -= 1
            else:
                ids.append(code)
                end -= lengths[code]
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        known = self.known
        for part in self.parts.findall(SPACE + text.replace(" ", SPACE)):
            got = known.get(part)
            if got is None:
                got = self.part_ids(part)
                if len(part) <= REMEMBERED_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = got
            ids.extend(got)
        return ids

    def decode(self, ids: list[int]) -> str:
        out: list[str] = []
        held = bytearray()
        byte_of = self.byte_of
        pieces = self.pieces
        for i in ids:
            b = byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(_utf8(held))
                held.clear()
            out.append("" if i in self.control and i else " ⁇ " if i in self.control else pieces[i])
        if held:
            out.append(_utf8(held))
        text = "".join(out).replace(SPACE, " ")
        first = ids[0] if ids else None
        return text[1:] if first is not None and first not in byte_of and text.startswith(" ") else text


def _utf8(held: bytearray) -> str:
    """Valid runs as text, each other byte as the replacement character."""
    try:
        return held.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(held):
            for n in range(1, 5):
                try:
                    out.append(held[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): the ids of each text, and the text that they decode to."""
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(model.value)
        for batch in batches:
            step = 256
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                ids, decoded = [], []
                for text in some.column(1):
                    got = pieces.encode(text.as_py() or "")
                    ids.append(pa.array(got, pa.int32()))
                    decoded.append(pieces.decode(got))
                offsets = [0]
                for one in ids:
                    offsets.append(offsets[-1] + len(one))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(ids))
                yield pa.RecordBatch.from_arrays([some.column(0).cast(pa.int64()), lists, pa.array(decoded)], schema=out)

    return narrow.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_documents(table(spark, sf_dir, "documents"), default_model()))
