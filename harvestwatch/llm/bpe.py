"""BPE encoding and decoding by prefix-sharing trie traversal (operator 1).

For a vocabulary whose every token stems from one merge, a sequence of tokens
is the BPE encoding of its text exactly when each adjacent pair is one that no
merge would have joined or torn apart earlier.  So every prefix of a word has
one state, its last token: the token that ends the prefix and goes with the
last token of what stands before it.  The distinct words of a run of documents
are visited in sorted order, which is the depth-first order of their trie; the
stack holds the states along the current path, so the encoding of a shared
prefix is computed once.  A word's ids are read off by walking the last tokens
back to the root.

The work is one pass over the documents (``mapInArrow``, no shuffle): a hot
source or group of copies changes nothing, a lost task is redone from its input
split.  A worker holds the ids of at most ``MAX_WORDS`` distinct words and
starts anew beyond that, which changes time, never results.

Defined results: a null text counts as empty and has no ids; an empty ``ids``
array decodes to the empty string; null ids decode to null; repeated rows are
encoded alike; columns with the added names are replaced, all others stay.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import prepare, slices, table, with_columns_replaced
from ._unicode import WHITE_SPACE, category_class

MAX_WORDS = 800_000
END = "</w>"
FOREVER = 1 << 60
LOW = 0x24F  # Latin letters with marks


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Codes(dict):
    """word -> dense code; unseen words get the next code and are noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table_, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in table_:
            table_[b] = chr(256 + extra)
            extra += 1
    return [table_[b] for b in range(256)]


def word_pattern(last: int) -> re.Pattern:
    """Fixed pattern of the vocabulary (contractions, letters, single numbers,
    other signs) with its classes written out up to a code point; a short class
    is matched faster."""
    letters, numbers = category_class("L", last), category_class("N", last)
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[^{WHITE_SPACE}{letters}{numbers}]+|[{numbers}]")


def _ends(tokens: dict[str, int]) -> dict[str, int]:
    """Every end of every token with the token's id, or -1 where it is none itself."""
    out = {token[k:]: -1 for token in tokens for k in range(1, len(token))}
    return out | tokens


class Bpe:
    """A word-level BPE vocabulary (byte symbols, end-of-word mark) with its trie encoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.tokens = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        self.rank: dict[int, int] = {}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for k, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank[left << 20 | right] = k
            self.made[whole], self.parts[whole] = k, (left, right)
        if len(self.parts) != len(self.rank):
            raise ValueError("a token stems from two merges; last-token states need one")
        self.spines: tuple[dict, dict] = {}, {}
        self.fits: dict[int, bool] = {}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for token, i in vocab.items():
            if token in self.special or not self._whole(i):
                continue
            if token.endswith(END):
                self.final[token[:-len(END)]] = i
            else:
                self.inner[token] = i
        # All ends of tokens: the longer candidates of a prefix are tried only while they are one.
        self.inner_ends, self.final_ends = _ends(self.inner), _ends(self.final)
        self.words = word_pattern(sys.maxunicode).findall
        self.words_low = word_pattern(LOW).findall
        self.beyond_low = re.compile(f"[^\\x00-\\u{LOW:04x}]").search
        self.control = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.symbols = dict(enumerate(byte_symbols()))
        self._reset()

    # -- which tokens may stand side by side ---------------------------------

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one end of a token with the merge that takes each up."""
        out = self.spines[side].get(token)
        if out is None:
            out, at, until = [], token, FOREVER
            while at is not None:
                out.append((at, until))
                until, at = self.made.get(at), self.parts.get(at, (None, None))[side]
            self.spines[side][token] = out
        return out

    def _free(self, left: int, right: int, before: int) -> bool:
        """No merge of rank under ``before`` joins the end of ``left`` to the start of ``right``."""
        rank, ends = self.rank.get, self._spine(right, 0)
        for a, a_until in self._spine(left, 1):
            for b, b_until in ends:
                k = rank(a << 20 | b)
                # equal ranks: the pair further left is merged first
                if k is not None and k < before and k < a_until and k <= b_until:
                    return False
        return True

    def _whole(self, token: int) -> bool:
        """Whether a token's own text is encoded as that token."""
        return token not in self.parts or self._free(*self.parts[token], self.made[token])

    # -- the trie -------------------------------------------------------------

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words (in byte symbols); sorted words share the most."""
        inner, final, fits, free = self.inner_ends.__getitem__, self.final_ends.__getitem__, self.fits, self._free
        fit_of = fits.get
        last, start, before, out = [0] * 64, [0] * 64, "", []
        for word in words:
            n = len(word)
            if n >= len(last):
                last += [0] * n
                start += [0] * n
            i, most = 0, min(n, len(before)) - 1
            while i < most and word[i] == before[i]:
                i += 1
            before = word
            while i < n:
                i += 1
                find, j = (inner if i < n else final), i - 1
                while True:
                    token = find(word[j:i])
                    if token >= 0:
                        if j == 0:
                            break
                        key = last[j] << 20 | token
                        fit = fit_of(key)
                        if fit is None:
                            fit = fits[key] = free(last[j], token, FOREVER)
                        if fit:
                            break
                    j -= 1
                last[i], start[i] = token, j
            ids = [last[n]]
            j = start[n]
            while j:
                ids.append(last[j])
                j = start[j]
            ids.reverse()
            out.append(ids)
        return out

    # -- texts ----------------------------------------------------------------

    def _reset(self) -> None:
        self.codes = _Codes()
        self.flat = np.empty(1 << 16, np.int32)
        self.begin, self.count = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = 0
        if len(self.fits) > 2_000_000:
            self.fits.clear()

    def _split(self, text: str) -> list[str]:
        """Words of a text; control tokens keep a leading NUL that no word has."""
        if "<|" in text:
            parts = self.control.split(text)
            if len(parts) > 1:
                return [w for k, part in enumerate(parts)
                        for w in (["\0" + part] if k % 2 else self._split_plain(part))]
        return self._split_plain(text)

    def _split_plain(self, text: str) -> list[str]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower-cased by itself, not by its place in the word
                text = text.replace("Σ", "σ")
        text = text.lower()
        return self.words(text) if self.beyond_low(text) else self.words_low(text)

    def _learn(self) -> None:
        """Encode the words noted since the last call."""
        new = self.codes.new
        if not new:
            return
        shown = [(w if w.isascii() else w.encode().decode("latin-1").translate(self.symbols)) for w in new]
        if any(not w.isprintable() for w in shown):
            shown = [w if w.isprintable() or w[0] == "\0" and w[1:] in self.special
                     else o.encode().decode("latin-1").translate(self.symbols)
                     for w, o in zip(shown, new, strict=True)]
        order = sorted(range(len(new)), key=shown.__getitem__)
        plain = [k for k in order if not (new[k][0] == "\0" and new[k][1:] in self.special)]
        ids: list[list[int]] = [[]] * len(new)
        for k, got in zip(plain, self.encode_words([shown[k] for k in plain]), strict=True):
            ids[k] = got
        if len(plain) < len(new):
            for k in set(order) - set(plain):
                ids[k] = [self.special[new[k][1:]]]
        first, counts = len(self.codes) - len(new), np.fromiter(map(len, ids), np.int64, len(new))
        total = int(counts.sum())
        while len(self.count) < len(self.codes):
            self.begin, self.count = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.count, 2 * len(self.count))
        while len(self.flat) < self.used + total:
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.count[first:first + len(new)] = counts
        self.begin[first:first + len(new)] = self.used + np.cumsum(counts) - counts
        self.flat[self.used:self.used + total] = np.fromiter((i for w in ids for i in w), np.int32, total)
        self.used += total
        new.clear()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as int32 arrays."""
        if len(self.codes) > MAX_WORDS:
            self._reset()
        code = self.codes.__getitem__
        coded = [np.array(list(map(code, self._split(t))), np.int64) if t else np.empty(0, np.int64) for t in texts]
        self._learn()
        out = []
        for c in coded:
            counts = self.count[c]
            ends = np.cumsum(counts)
            shift = np.repeat(self.begin[c] - ends + counts, counts)
            out.append(self.flat[shift + np.arange(len(shift))])
        return out

    def decode(self, ids) -> str:
        """Tokens joined by one space: the vocabulary has no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The vocabulary, once per worker process."""
    return Bpe(path)


def _list_array(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else [], pa.int32()))


def _mapped(df: DataFrame, work, column: str, added: list[T.StructField]) -> DataFrame:
    """``df`` with added columns made by ``work(list of values) -> list of arrays``, run by run."""
    df = with_columns_replaced(df, *[f.name for f in added if f.name.lower() != column.lower()])
    at = [c.lower() for c in df.columns].index(column.lower())

    def run(batches):
        for batch in batches:
            for part in _runs(batch, at):
                made = work(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *names])

    names = [f.name for f in added]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


def _runs(batch: pa.RecordBatch, at: int):
    if pa.types.is_list(batch.schema.field(at).type):
        for i in range(0, batch.num_rows, 256):
            yield batch.slice(i, 256)
    else:
        yield from slices(batch, at)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None,
           decoded: str | None = None) -> DataFrame:
    """Add the token ids of a text column (``array<int>``); with ``decoded``
    also the text that decoding those ids gives."""
    prepare(df.sparkSession)
    path = path or default_path()

    def work(texts):
        bpe = load(path)
        arrays = bpe.encode(texts)
        made = [_list_array(arrays)]
        if decoded:
            made.append(pa.array([bpe.decode(a.tolist()) for a in arrays], pa.string()))
        return made

    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded:
        added.append(T.StructField(decoded, T.StringType()))
    return _mapped(df, work, text, added)


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the decoded text of a column of token ids."""
    prepare(df.sparkSession)
    path = path or default_path()

    def work(values):
        bpe = load(path)
        return [pa.array([None if v is None else bpe.decode(v) for v in values], pa.string())]

    return _mapped(df, work, ids, [T.StructField(decoded, T.StringType())])


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of both."""
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
