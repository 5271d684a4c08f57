"""Byte-pair encoding by a trie of the distinct words, and decoding.

The words of a batch are sorted, so that walking through them is a depth-first walk of their trie.
Each node keeps one state, the last token of the encoding of its prefix: the one token that ends
there and may follow the last token of the prefix before it; there is always one, since single letters
are tokens. A shared prefix is worked out once; the
encoding of a word is read by following last tokens back to the root.

Defined cases: a null or empty text has no tokens and decodes to the empty text; a word of any length
takes memory in proportion to its length; repeated rows and extra columns pass through; an empty
table gives an empty table; a column with the name of a new column is replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import add_columns, by_place, chunks, map_in_arrow, named

END = "</w>"
# White space as the tokenizer's pattern language has it (fixed values).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Ids of known words and judged pairs of tokens that a worker keeps between batches.
IDS_KEPT = 1_000_000
PAIRS_KEPT = 400_000

ENCODED = T.StructType([
    T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType())])
DECODED = T.StructType([T.StructField("decoded", T.StringType())])


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where printable, else from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return letters


def letter_class(below: int) -> tuple[str, str]:
    """The letters and the decimal and other numbers below a code point, as character classes."""
    kinds = {"L": [], "N": []}
    for c in range(below):
        if (kind := unicodedata.category(chr(c))[0]) in kinds:
            kinds[kind].append(f"\\u{c:04x}")
    return "".join(kinds["L"]), "".join(kinds["N"])


class TrieEncoder:
    """Encodes words with the vocabulary and merges of one tokenizer file."""

    LATIN = 0x250

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        # tokens are numbered in the order in which merging makes them: single letters first
        made = [a + b for a, b in pairs]
        single = [t for t in vocab if len(self._letters(t)) == 1]
        self.names = [*single, *made]
        self.number = {t: k for k, t in enumerate(self.names)}
        self.joined = {(self.number[a], self.number[b]): self.number[a + b] for a, b in pairs}
        self.left = [*range(len(single)), *(self.number[a] for a, _ in pairs)]
        self.right = [*range(len(single)), *(self.number[b] for _, b in pairs)]
        self.size = [len(self._letters(t)) for t in self.names]
        self.ids = [vocab[t] for t in self.names]
        self.longest = max(self.size)
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        ids = vocab | self.special
        self.tokens = [""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.tokens[i] = token
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        short = "'s|'t|'re|'ve|'m|'ll|'d"
        self.words = regex.compile(rf"{short}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        letters, numbers = letter_class(self.LATIN)
        self.latin = re.compile(rf"{short}|[{letters}]+|[{numbers}]|[^{SPACE}{letters}{numbers}]+")
        self.other = re.compile(f"[^\\x00-{chr(self.LATIN - 1)}]")
        self.byte_table = byte_letters()
        self.follows: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}  # number of each known word
        self.flat: list[int] = []  # ids of the known words, one after the other
        self.ends: list[int] = [0]
        self.arrays: tuple[np.ndarray, np.ndarray] | None = None
        for token, i in self.special.items():
            self._keep(token, [i])

    def _keep(self, word: str, ids: list[int]) -> None:
        self.place[word] = len(self.place)
        self.flat += ids
        self.ends.append(len(self.flat))

    @staticmethod
    def _letters(token: str) -> tuple[str, ...]:
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return (*body[:-1], body[-1] + END)
        return tuple(token)

    def may_follow(self, first: int, second: int) -> bool:
        """Whether merging the letters of both tokens gives back these two.

        Merging is run backwards: the token made later is parted again, and what stands at the border
        must not be a pair that would have been merged before that step.
        """
        key = first * len(self.names) + second
        if (known := self.follows.get(key)) is not None:
            return known
        if len(self.follows) > PAIRS_KEPT:
            self.follows.clear()
        a, b, before = first, second, len(self.names)
        fits = True
        while fits:
            if self.joined.get((a, b), before) < before:
                fits = False
            elif a > b and self.right[a] != a:
                before, a = a, self.right[a]
            elif self.left[b] != b:
                before, b = b + 1, self.left[b]  # of equal steps the left one came first
            elif self.right[a] != a:
                before, a = a, self.right[a]
            else:
                break
        self.follows[key] = fits
        return fits

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet, by one depth-first walk over their trie."""
        new = words - self.place.keys()
        if not new:
            return
        if len(self.flat) > IDS_KEPT:
            self.forget()
            new = words - self.place.keys()
        self.arrays = None
        table, size, may_follow, longest, many = self.byte_table, self.size, self.may_follow, self.longest, len(self.names)
        number_of, known_pair = self.number.get, self.follows.get
        spelled = sorted((w.encode().decode("latin-1").translate(table), w) for w in new)
        states: list[int] = [-1]  # states[i]: last token of the first i letters on the path
        path = ""
        for word, given in spelled:
            n, shared, limit = len(word), 0, min(len(path), len(word) - 1)
            while shared < limit and path[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            for i in range(shared + 1, n):
                j = i - longest if i > longest else 0
                while j < i:
                    token = number_of(word[j:i])
                    if token is not None:
                        if not j:
                            break
                        fits = known_pair(states[j] * many + token)
                        if fits or fits is None and may_follow(states[j], token):
                            break
                    j += 1
                states.append(token)
            end = word + END  # the last letter carries the end of the word
            for j in range(n - longest if n > longest else 0, n):
                token = number_of(end[j:])
                if token is not None and (j == 0 or may_follow(states[j], token)):
                    states.append(token)
                    break
            ids, i = [], n
            while i:
                token = states[i]
                ids.append(self.ids[token])
                i -= size[token]
            ids.reverse()
            states.pop()  # the end of a word is no inner node
            path = word[:-1]
            self._keep(given, ids)

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text, the latter as they stand."""
        out: list[str] = []
        for piece in self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]:
            if piece in self.special:
                out.append(piece)
            elif piece:
                plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                out += (self.words if self.other.search(plain) else self.latin).findall(plain)
        return out

    def encode_arrays(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each text's."""
        cut = [self.split(t) if t else [] for t in texts]
        self.learn({w for words in cut for w in words})
        if self.arrays is None:
            self.arrays = np.array(self.flat, np.int32), np.array(self.ends, np.int64)
        flat, ends = self.arrays
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        look = self.place.__getitem__
        words = np.fromiter((k for row in cut for k in map(look, row)), np.int64, int(lengths.sum()))
        counts = ends[words + 1] - ends[words]
        upto = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(upto[-1]) + np.repeat(ends[words] - upto[:-1], counts)
        bounds = upto[np.concatenate([[0], np.cumsum(lengths)])]
        return flat[at], np.diff(bounds)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        flat, counts = self.encode_arrays(texts)
        return [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])] if texts else []

    def decode(self, ids) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[int, TrieEncoder] = {}


def _encoder(content) -> TrieEncoder:
    """One encoder per worker and tokenizer."""
    if content.id not in _LOADED:
        _LOADED.clear()
        _LOADED[content.id] = TrieEncoder(content.value)
    return _LOADED[content.id]


class _Shared:
    """The bytes of a tokenizer file, sent once to each executor. Their size is that of the vocabulary."""

    def __init__(self, spark, path: str):
        content = Path(path).read_bytes()
        self.cast = spark.sparkContext.broadcast(content)
        self.id = zlib.crc32(content)

    @property
    def value(self) -> bytes:
        return self.cast.value


def bpe_encode(df: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` with ``token_ids`` and ``n_tokens`` of a text column, for the tokenizer file at ``path``.

    With ``decoded`` also the text that the ids decode to, in the same pass over the data.
    """
    shared = _Shared(df.sparkSession, path)

    def encode(texts):
        encoder = _encoder(shared)
        flat, counts = encoder.encode_arrays(texts)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        columns = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)), pa.array(counts)]
        if decoded:
            columns.append(pa.array([encoder.decode(flat[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])], pa.string()))
        return columns

    return add_columns(df, text, T.StructType(ENCODED.fields + DECODED.fields) if decoded else ENCODED, encode)


def bpe_decode(df: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded``, the text of a column of token ids; null ids decode to the empty text."""
    shared = _Shared(df.sparkSession, path)
    out = T.StructType([f for f in df.schema.fields if f.name.lower() != "decoded"] + DECODED.fields)
    source = df.select(*(named(f.name) for f in out.fields[:-1]))
    at, schema = source.columns.index(ids), to_arrow_schema(out)

    def rows(batches):
        for batch in batches:
            column = batch.column(at)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_pylist()
            for lo, hi in chunks(sizes, IDS_KEPT):
                part, encoder, texts = batch.slice(lo, hi - lo), _encoder(shared), []
                for k in range(lo, hi):
                    texts.append(encoder.decode(column[k].values.to_numpy(zero_copy_only=False).tolist()) if column[k].is_valid else "")
                yield by_place([*part.columns, pa.array(texts, pa.string())], schema)

    return map_in_arrow(source, rows, out)
