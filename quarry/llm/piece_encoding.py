"""SentencePiece byte-pair encoding by backtracking, and decoding.

The model's ids for a text are those left when the best-scored pair of neighbours is merged
until none can be.  They are found without merging the text: a sequence of pieces is
that result exactly if every two neighbours are what merging their joined text leaves.
From the left, the longest piece that stands at the place (all matches come from one
Aho-Corasick scan) is tried, then its shorter prefixes; a piece is taken if it agrees with
the one before it; where none does, the place is marked in a bit field of failed places and
the last piece is given back.  Whether two pieces agree is found by merging both side by
side and watching the pair that meets at their border.

No piece spans two characters that stand side by side in no piece, so a text is cut
there first, and the cuts' ids are kept in a bounded cache.  A character that is no piece
becomes its UTF-8 bytes' pieces.  Decoding is the library's.

Defined cases: a null or empty text is the end id alone; repeated rows are encoded once
each; null ids are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import kept_in_stage, map_rows

SPACE = "▁"
#: Entries of each of a worker's caches, before it starts anew.
CACHE_ENTRIES = 400_000
#: Bytes of texts that are encoded at a time.
BATCH_BYTES = 1 << 20
NEVER = float("-inf")

ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """The pieces of a model with their scores, and what merging makes of them."""

    def __init__(self, processor):
        import ahocorasick

        sp = processor
        ids = range(sp.get_piece_size())
        special = {i for i in ids if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)}
        if any(sp.is_unused(i) for i in ids) or sum(sp.is_byte(i) for i in ids) != 256:
            raise ValueError("only models with byte pieces and without unused pieces are supported")
        self.id_of = {sp.id_to_piece(i): i for i in ids if i not in special}
        self.score = {piece: sp.get_score(i) for piece, i in self.id_of.items()}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.beside = {piece[i : i + 2] for piece in self.id_of for i in range(len(piece) - 1)}
        self.matches = ahocorasick.Automaton()
        for piece in self.id_of:
            self.matches.add_word(piece, len(piece))
        self.matches.make_automaton()
        self.logs: dict[str, tuple | None] = {}
        self.agreed: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """What merging leaves of ``text``, and of each merge the score and the first and last
        symbol after it."""
        symbols, log, score = list(text), [], self.score
        while len(symbols) > 1:
            found = [score.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
            best = max(found)
            if best == NEVER:
                break
            at = found.index(best)  # the leftmost of equals
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            log.append((best, symbols[0], symbols[-1]))
        return symbols, log

    def log(self, piece: str) -> tuple | None:
        """The merges that make ``piece``; None if merging doesn't give it whole."""
        got = self.logs.get(piece, 0)
        if got == 0:
            symbols, log = self.merged(piece)
            got = self.logs[piece] = (*log, (NEVER, piece, piece)) if len(symbols) == 1 else None
        return got

    def agree(self, left: str, right: str) -> bool:
        """Whether merging the joined text leaves just these two."""
        got = self.agreed.get((left, right))
        if got is None:
            if len(self.agreed) > CACHE_ENTRIES:
                self.agreed.clear()
            got = self.agreed[left, right] = self._agree(left, right)
        return got

    def _agree(self, left: str, right: str) -> bool:
        logs = self.log(left), self.log(right)
        if logs[0] is None or logs[1] is None:
            return False
        a, b, i, j = left[-1], right[0], 0, 0
        score = self.score
        while True:
            next_left, next_right, across = logs[0][i][0], logs[1][j][0], score.get(a + b, NEVER)
            # of equal scores the leftmost merge is made first
            if across > next_left and across >= next_right:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left >= next_right:
                a = logs[0][i][2]
                i += 1
            else:
                b = logs[1][j][1]
                j += 1

    def shorter(self, piece: str) -> str | None:
        """The longest proper prefix that is a piece."""
        for n in range(len(piece) - 1, 0, -1):
            if piece[:n] in self.score:
                return piece[:n]
        return None

    def pieces(self, text: str) -> list[str]:
        """The pieces of a non-empty text whose characters all lie side by side in pieces."""
        if text in self.score and self.log(text):
            return [text]
        longest = [1] * len(text)  # a character that is no piece stands alone
        for end, n in self.matches.iter(text):
            longest[end - n + 1] = n  # ends come in rising order
        taken: list[str] = []
        failed = 0
        place, size = 0, len(text)
        piece: str | None = text[: longest[0]]
        while place < size:
            while piece is not None:
                end = place + len(piece)
                if not failed >> end & 1 and (self.agree(taken[-1], piece) if taken else self.log(piece)):
                    break
                piece = self.shorter(piece)
            if piece is None:
                if not taken:
                    raise ValueError(f"no encoding of {text!r}")
                failed |= 1 << place
                piece = taken.pop()
                place -= len(piece)
            else:
                taken.append(piece)
                place = end
                if place < size:
                    piece = text[place : place + longest[place]]
        return taken

    def cuts(self, text: str) -> Iterator[str]:
        start = 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in self.beside:
                yield text[start:i]
                start = i
        yield text[start:]

    def ids(self, text: str) -> list[int]:
        """Ids of a part that stands between two cuts."""
        out: list[int] = []
        for piece in self.pieces(text):
            own = self.id_of.get(piece)
            out += [own] if own is not None else [self.byte_id[b] for b in piece.encode("utf-8")]
        return out


class Encoder:
    """Texts to ids, with what a worker keeps: parts between cuts and words, with their ids."""

    def __init__(self, processor):
        self.sp, self.vocabulary = processor, Vocabulary(processor)
        self.end = processor.eos_id()
        self.parts: dict[str, list[int]] = {}
        self.words: dict[str, list[int]] = {}
        self.spaced = not any(SPACE in piece.lstrip(SPACE) for piece in self.vocabulary.id_of)
        self.plain = processor.normalize("a b") == f"{SPACE}a{SPACE}b" and processor.normalize("  ") == SPACE * 3

    def part_ids(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.vocabulary.cuts(text):
            got = self.parts.get(part)
            if got is None:
                got = self.vocabulary.ids(part)
                if len(part) <= 64:
                    self.parts[part] = got
            out += got
        return out

    def word_ids(self, word: str) -> list[int]:
        got = self.part_ids(SPACE + word)
        if len(word) <= 64:
            self.words[word] = got
        return got

    def encode(self, text: str) -> list[int]:
        for cache in (self.parts, self.words):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
        out: list[int] = []
        words = text.split(" ")
        if text and self.plain and self.spaced and SPACE not in text and "" not in words:
            # a word begins with its space, and no piece goes on into the next one
            known = self.words.get
            for word in words:
                got = known(word)
                out += got if got is not None else self.word_ids(word)
        elif text:
            out = self.part_ids(self.sp.normalize(text))
        return [*out, self.end]

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


@kept_in_stage
def encoder(path: str) -> Encoder:
    import sentencepiece

    return Encoder(sentencepiece.SentencePieceProcessor(model_file=path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of each row."""

    def make():
        own = encoder(path)

        def step(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            ids = [own.encode(t or "") for t in texts]
            decoded = [own.decode(x) for x in ids]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

        return step

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, ENCODED, max_bytes=BATCH_BYTES)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Of each row the number of ids, and SHA-256 of the ids as text and of the decoded text."""
    done = encode(docs, path)
    as_text = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return done.select("doc_id", "n_tokens", F.sha2(as_text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
