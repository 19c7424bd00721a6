"""Encoding and decoding with a SentencePiece BPE model, exactly as its library does.

The library merges, of all neighbours whose concatenation is a piece, those with the best score, the leftmost of equals,
until none is left. Here the same pieces are found without merging a text. A row of pieces is the result for its text if
and only if every two neighbours are: merged anew, the text of the two gives just these two again. So a text is encoded
from left to right. An Aho-Corasick automaton gives the longest piece that starts at a place. The longest piece is tried
that fits the piece before it, then the longest piece that is a
prefix of that, and so on. A place where none is left is marked in a bit field and never entered again, and the search
steps back by a piece. What the pieces before a place are depends on the place alone, so a mark holds for good.

No piece reaches over the end of a word, so words are encoded by themselves, and each task remembers those that it has met.
Characters that no piece has become bytes, which have pieces of their own.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayline.llm.common import table, whole_text

BLANK = "▁"  # fixed value: how the library writes a blank
REMEMBERED = 400_000  # words, and pairs of pieces, that a task remembers
LONGEST_REMEMBERED = 40
DOCS_AT_A_TIME = 512


class Words(dict):
    """The ids of words met lately: when there are too many, those go that were not asked for since the last time."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Pairs(dict):
    """For each left piece the right ones and whether they fit; all go when there are too many."""

    def __init__(self, fits: Callable[[int, int], bool]):
        super().__init__()
        self.fits, self.size = fits, 0

    def __missing__(self, left: int) -> Rights:
        row = self[left] = Rights(self, left)
        return row


class Rights(dict):
    def __init__(self, pairs: Pairs, left: int):
        super().__init__()
        self.pairs, self.left = pairs, left

    def __missing__(self, right: int) -> bool:
        pairs = self.pairs
        if pairs.size >= REMEMBERED:
            pairs.clear()
            pairs.size = 0
        pairs.size += 1
        fits = self[right] = pairs.fits(self.left, right)
        return fits


class Model:
    """The pieces of a model file and their scores.

    Served are BPE models with bytes for unknown characters that leave a text as it is but for a blank in front. Other
    models raise.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kind, normal = proto.ModelProto.SentencePiece, model.normalizer_spec
        if (model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback
                or model.trainer_spec.treat_whitespace_as_suffix or normal.remove_extra_whitespaces
                or normal.precompiled_charsmap or not normal.add_dummy_prefix or not normal.escape_whitespaces
                or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces)):
            raise ValueError(f"{path} is not a BPE model of bytes and unchanged texts")
        self.pieces = [p.piece for p in model.pieces]
        normals = [i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
        self.ids = {self.pieces[i]: i for i in normals}
        self.scores = {self.pieces[i]: model.pieces[i].score for i in normals}
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError(f"{path} has a piece with a character that is no piece")
        # a word is blanks and what follows them, unless a piece holds a blank behind other characters
        inner = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.words = re.compile("(?s).+" if inner else f"(?s){BLANK}*[^{BLANK}]+|{BLANK}+")
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i, p in enumerate(model.pieces) if p.type == kind.CONTROL}
        self.unknown = {i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN}
        self.length = [len(p) for p in self.pieces]
        self.prefix = [self._longest_prefix(p) for p in self.pieces]  # the longest piece that a piece begins with
        self.characters = frozenset(p for p in self.ids if len(p) == 1)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.ends: dict[int, tuple | None] = {}
        self.known_words = Words(self._encode_word)
        self.known_pairs = Pairs(self._fits)
        self.plain = [p.replace(BLANK, " ").encode() for p in self.pieces]
        for i in self.control:
            self.plain[i] = b""
        for i in self.unknown:
            self.plain[i] = " ⁇ ".encode()  # fixed value: how the library shows an unknown piece
        for i, b in self.byte_of.items():
            self.plain[i] = bytes([b])
        first = [t[1:] if p.startswith(BLANK) else t for p, t in zip(self.pieces, self.plain)]
        self.all_plain = pa.array(self.plain + first, pa.binary())
        self.special = np.array(sorted(self.control | self.byte_of.keys()))

    def _longest_prefix(self, piece: str) -> int:
        return next((self.ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), -1)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text of known characters, by merging."""
        parts, scores, worst = list(text), self.scores, float("-inf")
        pairs = [scores.get(a + b, worst) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > worst:
            at = pairs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = scores.get(parts[at - 1] + parts[at], worst)
            if at < len(pairs):
                pairs[at] = scores.get(parts[at] + parts[at + 1], worst)
        return parts

    def _replay(self, piece: str) -> tuple[list[tuple[str, float]], list[tuple[str, float]]] | None:
        """What stands at the right and at the left end of a piece while it is merged, from the piece down to a character,
        each with the time at which the next one takes its place; better scores are earlier times.

        None where the merges do not come in the order of their scores, all different.
        """
        parts, now, right, left = list(piece), float("-inf"), [], []
        while len(parts) > 1:
            scores = [self.scores.get(a + b, float("-inf")) for a, b in zip(parts, parts[1:])]
            at = scores.index(max(scores))
            if -scores[at] <= now:
                return None
            now = -scores[at]
            if at == len(parts) - 2:
                right.append((parts[-1], now))
            if at == 0:
                left.append((parts[0], now))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [*right, (piece, float("inf"))][::-1], [*left, (piece, float("inf"))][::-1]

    def _fits(self, left: int, right: int) -> bool:
        """Merges two pieces in step: at any time one part of each meets the other, and those must not merge before either
        is merged with its own neighbour."""
        for piece in (left, right):
            if piece not in self.ends:
                self.ends[piece] = self._replay(self.pieces[piece])
        if self.ends[left] is None or self.ends[right] is None:
            a, b = self.pieces[left], self.pieces[right]
            return self.merged(a + b) == [a, b]
        rights, lefts, scores, never = self.ends[left][0], self.ends[right][1], self.scores, float("-inf")
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = rights[i], lefts[j]
            joined = scores.get(a + b)
            if joined is not None and -joined < a_ends and -joined <= b_ends:  # of equal scores the leftmost goes first
                return False
            # before the later of the two was there; of those that come at one time the right one is later
            a_begins = rights[i + 1][1] if i + 1 < len(rights) else never
            b_begins = lefts[j + 1][1] if j + 1 < len(lefts) else never
            if a_begins > b_begins:
                i += 1
            elif b_begins > never:
                j += 1
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the text of two pieces gives these two."""
        return self.known_pairs[left][right]

    def _search(self, word: str) -> list[int]:
        """The pieces of known characters."""
        pairs, found, last = self.known_pairs, [], -1
        for stop, piece in self.automaton.iter_long(word):  # the longest matches, one behind the other
            if last >= 0 and not pairs[last][piece]:
                return self._search_on(word, found, stop + 1 - self.length[piece], piece)
            found.append(piece)
            last = piece
        return found

    def _search_on(self, word: str, found: list[int], at: int, piece: int) -> list[int]:
        """``_search`` from a place on whose longest piece does not fit the pieces found."""
        longest, length, prefix, pairs = self.automaton.iter_long, self.length, self.prefix, self.known_pairs
        failed, end, stop, matches = bytearray(len(word) // 8 + 1), len(word), -1, iter(())
        while True:
            to = at + length[piece]
            if not failed[to >> 3] >> (to & 7) & 1 and (not found or pairs[found[-1]][piece]):
                found.append(piece)
                if to == end:
                    return found
                if stop != to:
                    matches = longest(word, to, end)
                at = to
                stop, piece = next(matches)
                stop += 1
                continue
            stop, piece = -1, prefix[piece]
            while piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                piece = found.pop()
                at -= length[piece]
                piece = prefix[piece]

    def _encode_word(self, word: str) -> bytes:
        if self.characters.issuperset(word):
            return array("i", self._search(word)).tobytes()
        ids: list[int] = []
        for known, run in groupby(word, self.characters.__contains__):
            part = "".join(run)
            ids += self._search(part) if known else [self.bytes[b] for b in part.encode("utf-8", "replace")]
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        words = self.words.findall(BLANK + text.replace(" ", BLANK)) if text else ()
        return b"".join(map(self.known_words.__getitem__, words))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes together are characters, broken ones U+FFFD each, and the blank in front goes."""
        parts, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            parts += [_characters(run), self.plain[i].decode()]
            run.clear()
        text = "".join(parts) + _characters(run)
        first = next((i for i in ids if i not in self.control), None)
        return text[1:] if first is not None and self.pieces[first].startswith(BLANK) else text

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of several rows of ids, which end at ``ends`` in ``ids``."""
        begins = np.append(0, ends[:-1])
        some = begins[begins < ends]
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            raise ValueError("an id outside the model")
        plain = ids.copy()
        plain[some] += len(self.pieces)  # the first one, without its blank
        texts = self.all_plain.take(pa.array(plain))
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:][np.append(0, ends)]
        data = texts.buffers()[2]
        # what these rules do not cover: control pieces in front, bytes that are no characters
        odd = np.zeros(len(ends) + 1, np.int64)
        special = np.isin(ids, self.special)
        odd = np.add.reduceat(np.append(special, False), np.minimum(begins, len(ids))) * (begins < ends) if len(ends) else odd
        raw, out, at = memoryview(data) if data is not None else memoryview(b""), [], 0
        for r in np.flatnonzero(odd).tolist():
            a, b = int(begins[r]), int(ends[r])
            try:
                if int(ids[a]) in self.control:
                    raise ValueError
                bytes(raw[offsets[r]:offsets[r + 1]]).decode()
            except ValueError:
                out += [(at, r), self.decode(ids[a:b].tolist())]
                at = r + 1
        whole = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), data or pa.py_buffer(b"")])
        parts = [whole.slice(x[0], x[1] - x[0]) if isinstance(x, tuple) else pa.array([x], pa.string()) for x in out]
        return pa.concat_arrays([*parts, whole.slice(at)])


def _characters(run: bytearray) -> str:
    """Bytes as characters; every byte that is part of none gives U+FFFD."""
    out, data = [], bytes(run)
    while data:
        try:
            return "".join(out) + data.decode("utf-8")
        except UnicodeDecodeError as broken:
            out += [data[:broken.start].decode("utf-8"), "�"]
            data = data[broken.start + 1:]
    return "".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One model per worker."""
    return Model(path)


def model_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _encode_rows(texts: pa.Array, path: str) -> pa.Array:
    encode, parts = model(path).encode, [pa.array([], pa.list_(pa.int32()))]
    for at in range(0, len(texts), DOCS_AT_A_TIME):
        ids = [encode(text or "") for text in texts.slice(at, DOCS_AT_A_TIME).to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]) // 4
        parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
    return pa.concat_arrays(parts)


def _decode_rows(rows: pa.Array, path: str) -> pa.Array:
    parts = [pa.array([], pa.string())]
    for at in range(0, len(rows), DOCS_AT_A_TIME):
        some = rows.slice(at, DOCS_AT_A_TIME)
        ends = np.cumsum(some.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        parts.append(model(path).decode_all(some.flatten().to_numpy(zero_copy_only=False), ends))
    return pa.concat_arrays(parts)


def encoded(text: Column, path: str | None = None) -> Column:
    """The token ids of a text, without begin or end ids; NULL and the empty text have none."""
    path = path or model_file()

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _encode_rows(texts, path)

    return encode(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of token ids; NULL has the empty text. Ids outside the model, NULL among them, raise."""
    path = path or model_file()

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        return _decode_rows(rows, path)

    return decode(ids)


def round_trip(text: Column, path: str | None = None) -> Column:
    """``ids`` and ``text``: what ``encoded`` gives and what ``decoded`` makes of that, from one encoding."""
    path = path or model_file()

    @F.arrow_udf("ids array<int>, text string")
    def both(texts: pa.Array) -> pa.Array:
        ids = _encode_rows(texts, path)
        return pa.StructArray.from_arrays([ids, _decode_rows(ids, path)], ["ids", "text"])

    return both(text)


def op12_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of tokens and digests of its ids and of the text that they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", round_trip(whole_text()).alias("_found"))
    return docs.select(
        "doc_id", F.size("_found.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("_found.ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("_found.text"), 256).alias("decoded_sha256"))
