"""Byte-pair encoding and decoding with a given public vocabulary.

The merge order fixes one encoding for every prefix of a piece of text, so it is enough to store the last token of each
prefix. Tokens that end at a place come from an automaton over the vocabulary (suffix links lead from the longest to the
shorter ones); of these exactly one continues the encoding of the text before it, found by testing the pair of tokens.
Following the stored tokens back from the end gives the ids.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame

from tessella.llm.common import add_columns, text_of, worker_cached

# Fixed value: how byte-level vocabularies cut a text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 40  # merge rank of what is never merged
MEMO = 300_000  # pieces kept per worker; a full memo is emptied and fills again


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """One vocabulary, ready to encode pieces of text; built once per worker from the file's text."""

    def __init__(self, spec: str):
        import ahocorasick
        import regex

        j = json.loads(spec)
        model, pre = j["model"], j["pre_tokenizer"]
        fixed = (model["type"], pre["type"], pre.get("add_prefix_space"), j["normalizer"], j["post_processor"], model.get("ignore_merges", False))
        if fixed != ("BPE", "ByteLevel", False, None, None, False) or not pre.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {fixed}")
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in model["vocab"]}
        self.bytes_of = {i: raw[t] for t, i in model["vocab"].items()}
        self.rank: dict[tuple[int, int], int] = {}
        born: dict[int, tuple[int, int, int]] = {}  # token -> (left part, right part, merge rank)
        vocab = model["vocab"]
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[vocab[a], vocab[b]] = r
            born.setdefault(vocab[a + b], (vocab[a], vocab[b], r))
        self.born = born
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        auto = ahocorasick.Automaton()
        for i, bs in self.bytes_of.items():
            if len(bs) == 1 or i in born:  # what no merge makes can't appear
                auto.add_word(bs.decode("latin-1"), (i, len(bs)))
        auto.make_automaton()
        self.auto = auto
        self.cut = regex.compile(PIECES).findall
        extra = j.get("added_tokens") or []
        if any(t[k] for t in extra for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with strip, word or normalising rules are not supported")
        self.extra = {t["content"]: t["id"] for t in extra}
        self.bytes_of |= {i: t.encode() for t, i in self.extra.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.extra, key=len, reverse=True))) + ")").split if self.extra else None
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo = _Memo(self)

    def _spine(self, t: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one end of ``t`` while it is merged, each with the merge rank that ends it."""
        out, until = [(t, NEVER)], NEVER
        while t in self.born:
            until = self.born[t][2]
            t = self.born[t][side]
            out.append((t, until))
        return out

    def pair_fits(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` and ``b`` is encoded as just these two tokens.

        It is not if some piece at the end of ``a`` and some piece at the start of ``b`` would have merged while both were
        there; of equal ranks the merge further left goes first.
        """
        got = self.fits.get((a, b))
        if got is None:
            if a not in self.right:
                self.right[a] = self._spine(a, 1)
            if b not in self.left:
                self.left[b] = self._spine(b, 0)
            rank, got = self.rank, True
            for x, end_x in self.right[a]:
                for y, end_y in self.left[b]:
                    r = rank.get((x, y))
                    if r is not None and r < end_x and r <= end_y:
                        got = False
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            self.fits[a, b] = got
        return got

    def piece(self, text: str) -> tuple[int, ...]:
        word = text.encode().decode("latin-1")
        n = len(word)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        fits, known = self.pair_fits, self.fits
        for end, (tok, length) in self.auto.iter(word):
            i = end + 1
            if last[i] < 0:
                s = i - length
                if s:
                    before = last[s]
                    ok = known.get((before, tok))
                    if ok is None:
                        ok = fits(before, tok)
                    if not ok:
                        continue
                last[i] = tok
                size[i] = length
        out, i = [], n
        while i:
            out.append(last[i])
            i -= size[i]
        return tuple(out[::-1])

    def encode(self, text: str):
        import numpy as np

        get = self.memo.__getitem__
        if self.split is None or not any(t in text for t in self.extra):
            return np.fromiter(chain.from_iterable(map(get, self.cut(text))), np.int32)
        ids: list[int] = []
        for part in self.split(text):
            if part in self.extra:
                ids.append(self.extra[part])
            else:
                ids.extend(chain.from_iterable(map(get, self.cut(part))))
        return np.array(ids, np.int32)

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Memo(dict):
    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, text: str) -> tuple[int, ...]:
        if len(self) > MEMO:
            self.clear()
        got = self.encoder.piece(text)
        if len(text) <= 64:
            self[text] = got
        return got


def _encoder(spec) -> Encoder:
    return worker_cached("bpe", spec.value, lambda: Encoder(spec.value))


def _lists(arrays):
    import numpy as np
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array of int), the encoding of each whole text; null text counts as empty.

    Strings of special tokens in a text become their ids, as the file asks. The vocabulary file (a fixed size, some MB) is read by
    the driver and broadcast. No shuffle; every row stands alone, so repeated rows, empty tables and other columns of any
    name pass through.
    """
    spec = docs.sparkSession.sparkContext.broadcast(open(vocab_path, encoding="utf-8").read())

    def run(texts):
        return [_lists([_encoder(spec).encode(t) for t in texts])]

    return add_columns(docs, [text_of(docs, text)], "token_ids array<int>", run, batch_rows=1000)


def decode(encoded: DataFrame, vocab_path: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of each list of ids, special tokens included; a null list gives empty text.
    Bytes that are not UTF-8 become U+FFFD. An id outside the vocabulary is an error."""
    spec = encoded.sparkSession.sparkContext.broadcast(open(vocab_path, encoding="utf-8").read())

    def run(lists):
        return [[_encoder(spec).decode(x or ()) for x in lists]]

    return add_columns(encoded, [encoded[f"`{ids}`"]], "decoded string", run, batch_rows=1000)


def round_trip(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows: adds ``token_ids`` and ``decoded``."""
    spec = docs.sparkSession.sparkContext.broadcast(open(vocab_path, encoding="utf-8").read())

    def run(texts):
        e = _encoder(spec)
        ids = [e.encode(t) for t in texts]
        return [_lists(ids), [e.decode(x.tolist()) for x in ids]]

    return add_columns(docs, [text_of(docs, text)], "token_ids array<int>, decoded string", run, batch_rows=1000)
