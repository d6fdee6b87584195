"""SentencePiece BPE encoding and decoding by a table of prefixes.

For every prefix of a text BPE leaves exactly one last token. That token is found
among the vocabulary pieces that end there (all of them come from one pass of an
Aho-Corasick automaton): it is the one that may stand after the last token of
the prefix before it, which two tokens may do when BPE of their joined
strings gives the same two tokens again. The ids are then read off
backwards from the end of the text. The table costs one entry per character however
long the text is, without a heap of merges.

No piece of the vocabularies taken here has a space mark after another
character, so a text falls into words (leading space marks and what follows)
that are encoded each on its own; a worker keeps the ids of words it has met.
"""

from __future__ import annotations

import re
import string
from array import array
from collections import Counter
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"  # how pieces write a space; a text's own marks are spaces, too
CACHED_WORDS = 400_000
LONGEST_CACHED = 64


class Vocabulary:
    """The pieces of one model and the tables built from them; one per Python worker."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (
            train.model_type != train.BPE
            or not train.byte_fallback
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.escape_whitespaces
            or train.treat_whitespace_as_suffix
        ):
            raise ValueError("a BPE model with byte fallback and the identity normaliser is needed")
        sp = SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        self.prefix = " " if norm.add_dummy_prefix else ""
        self.pieces = [sp.id_to_piece(i).replace(MARK, " ") for i in range(n)]
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        if any(sp.is_unused(i) for i in range(n)) or any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError("unused or user-defined pieces are not supported")
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        if any(" " in p.lstrip(" ") for p in self.id_of):
            raise ValueError("a piece has a space mark after another character")
        self.alphabet = set("".join(self.id_of))
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        apart = "" if "\n" in self.alphabet else "\n"
        self.words = re.compile(f" +[^ {apart}]*|[^ {apart}]+" + (f"|{apart}" if apart else "")).findall
        # no piece has such a character after a letter: there a word falls into parts of their own
        after_letter = {p[k] for p in self.id_of for k in range(1, len(p)) if p[k - 1].isalpha()}
        marks = "".join(re.escape(c) for c in string.punctuation if c not in after_letter)
        self.parts = re.compile(rf"(?<=[^\W\d_])(?=[{marks}])").split if marks else lambda word: [word]
        counts = Counter(self.score.values())
        self.tied = {p for p in self.id_of if counts[self.score[p]] > 1 and len(p) > 1}
        self.sizes = [len(p) for p in self.pieces]
        self.alone: list[bool | None] = [None] * n
        self.pairs: dict[int, bool] = {}
        self.joins: dict[str, tuple[str, str] | None] = {}
        # decoding: the bytes of every id; control ids give nothing, the unknown id its surface
        unknown = sp.unk_id()
        surface = proto.trainer_spec.unk_surface
        self.out = [b"" if sp.is_control(i) else p.encode() for i, p in enumerate(self.pieces)]
        self.out[unknown] = surface.encode()
        for i, b in self.byte_of.items():
            self.out[i] = bytes([b])
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.surfaces = pa.array(self.out, pa.large_binary())
        self.controls = np.array([sp.is_control(i) for i in range(n)])
        self.marked = np.array([p.startswith(" ") for p in self.pieces])
        self.ids = Words(self)

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain BPE of a short string: join the best scored pair, the leftmost of equals, until none is left.

        Gives the tokens and the last pair joined.
        """
        parts, last = list(text), None
        while len(parts) > 1:
            best = max(
                ((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score),
                default=None,
            )
            if best is None:
                break
            k = -best[1]
            last = (parts[k], parts[k + 1])
            parts[k : k + 2] = ["".join(last)]
        return parts, last

    def joined(self, piece: str) -> tuple[str, str] | None:
        """The two parts of a piece's last merge; None if BPE of its string is not the piece."""
        if piece not in self.joins:
            parts, last = self.merged(piece)
            self.joins[piece] = (last or (piece, "")) if len(parts) == 1 else None
        return self.joins[piece]

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE of both tokens' strings joined is these two tokens."""
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        a, b = self.pieces[left], self.pieces[right]
        known = self.pairs[left * len(self.sizes) + right] = self.joined(b) is not None and self._apart(a, b)
        return known

    def _apart(self, left: str, right: str) -> bool:
        """Undo the merges inside both tokens, the last first: at no time may the two parts at the seam have
        joined before the next merge of either. Scores that several pieces share are left to plain BPE."""
        a, b, score, tied = left, right, self.score, self.tied
        before, on_right = float("-inf"), False  # the merge undone last; of equal scores the leftmost comes first
        while True:
            if a in tied or b in tied:
                return self.merged(left + right)[0] == [left, right]
            if (seam := score.get(a + b)) is not None and (seam > before or on_right and seam == before):
                return False
            if len(a) == 1 and len(b) == 1:
                return True
            if len(b) == 1 or len(a) > 1 and score[a] < score[b]:
                before, on_right, a = score[a], False, self.joined(a)[1]
            else:
                before, on_right, b = score[b], True, self.joined(b)[0]

    def encode_word(self, word: str) -> bytes:
        """The ids of one word, as 32-bit numbers one after the other."""
        last = [-1] * len(word)  # the last token of each prefix by its last place; -1: none of the vocabulary
        last.append(-1)  # also what stands before the first place
        pairs, alone, sizes, n, known = self.pairs, self.alone, self.sizes, len(self.sizes), -1
        for end, token in self.automaton.iter(word):  # ends rise; the longest piece of an end comes first
            if end == known:
                continue
            before = last[end - sizes[token]]
            if before < 0:
                fits = alone[token]
                if fits is None:
                    fits = alone[token] = self.joined(self.pieces[token]) is not None
            else:
                try:
                    fits = pairs[before * n + token]
                except KeyError:
                    fits = self.follows(before, token)
            if fits:
                last[end] = token
                known = end
        back, end = [], len(word)
        while end:
            token = last[end - 1]
            if token < 0:  # a character outside the vocabulary: its bytes
                back.extend(self.byte_ids[b] for b in reversed(word[end - 1].encode()))
                end -= 1
            else:
                back.append(token)
                end -= sizes[token]
        back.reverse()
        return array("i", back).tobytes()

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text, as 32-bit numbers one after the other."""
        if not text:
            return b""
        return b"".join(map(self.ids.__getitem__, self.words(self.prefix + text.replace(MARK, " "))))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """What the library's decode gives: one leading space mark is the added one; broken bytes give U+FFFD each."""
        out = self.out
        raw = b"".join([out[i] for i in ids])
        first = next((i for i in ids if i not in self.control), None)
        if self.prefix and first is not None and self.pieces[first].startswith(" "):
            raw = raw[1:]
        if self.control.isdisjoint(ids):
            try:
                return raw.decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids, first)

    def decode_all(self, ids: np.ndarray, ends: list[int]) -> list[str]:
        """``decode`` of many texts whose ids stand one after the other: the bytes of all of them come from one gather."""
        chunk = self.surfaces.take(pa.array(ids))
        offsets = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset :]
        raw, control, marked = chunk.buffers()[2], self.controls[ids], self.marked
        plain = not control.any()
        out, begin = [], 0
        for end in ends:
            if begin == end:
                out.append("")
            elif plain or not control[begin:end].any():
                # the added space is the first byte
                skip = 1 if self.prefix and marked[ids[begin]] else 0
                try:
                    out.append(str(raw[int(offsets[begin]) + skip : int(offsets[end])], "utf-8"))
                except UnicodeDecodeError:
                    out.append(self.decode(ids[begin:end].tolist()))
            else:
                out.append(self.decode(ids[begin:end].tolist()))
            begin = end
        return out

    def _decode_runs(self, ids: list[int], first: int | None) -> str:
        parts, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        parts.append(bytes(run[:size]).decode())
                    except UnicodeDecodeError:
                        continue
                    break
                else:
                    size = 1
                    parts.append("�")
                del run[:size]
            if i is not None:
                parts.append(self.out[i].decode())
        text = "".join(parts)
        return text[1:] if self.prefix and first is not None and self.pieces[first].startswith(" ") else text


class Words(dict):
    """Ids of words met before, in two generations: a full one becomes the old one, whose words return when met again."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            parts = self.vocabulary.parts(word)
            if len(parts) == 1:
                ids = self.vocabulary.encode_word(word)
            else:
                ids = b"".join([self[part] for part in parts])
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(model: bytes) -> Vocabulary:
    if (key := hash(model)) not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(model)
    return _LOADED[key]


def _codecs(spark: SparkSession, model_path: str) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    with open(model_path, "rb") as f:  # a model file is about a megabyte; it travels with the job
        model = spark.sparkContext.broadcast(f.read())

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(model.value)
        coded = [vocabulary.encode_bytes(text.as_py() or "") for text in texts]
        ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(model.value)
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)).tolist()
        return pa.array(vocabulary.decode_all(flat, ends), pa.string())

    return encode, decode


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``: the ids of each whole text, without begin or end ids.

    A null or empty text has no ids. A column already named ``ids_col`` is replaced; all
    others, their order and repeated rows stay as they are.
    """
    return docs.withColumn(ids_col, _codecs(docs.sparkSession, model_path)[0](F.col(text_col)))


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col``: the text of each id list; null or no ids give the empty text."""
    return docs.withColumn(text_col, _codecs(docs.sparkSession, model_path)[1](F.col(ids_col)))
