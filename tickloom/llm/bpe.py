"""Byte-level BPE encoding and decoding by longest matches and backtracking.

Tokens are byte strings, mapped one byte to one Latin-1 character so that
``pyahocorasick`` tries over ``str`` hold them.  A sequence of tokens is the BPE
encoding of its bytes exactly when every adjacent pair of it is the BPE encoding of
the pair's bytes, and the first token is the encoding of its own.  The encoder
therefore takes the longest token at each position, checks it against the token
before it (checks are memoised), and steps back where nothing fits.  Positions that
led nowhere are marked, so every position is left at most once: time is linear in the
text for a vocabulary of bounded token length.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickloom.llm.common import Memo, lean, small_batches

#: Entries kept in each memo of a Python worker before it starts afresh.
MEMO_ENTRIES = 150_000
#: Pre-tokens longer than this are encoded each time, not remembered.
MEMO_CHARS = 64
#: Pre-tokens handled at once, so that a very long text needs no list of all of them.
CHUNK = 50_000
#: Ranks and pairs of ranks: larger than any rank, and no rank at all.
SHIFT, NEVER = 1 << 24, 1 << 60


class BytePairCodec:
    """Exact BPE over a ``tiktoken`` rank file, without special tokens."""

    def __init__(self, rank_lines: bytes, pattern: str) -> None:
        self.rank: dict[str, int] = {}
        for line in rank_lines.splitlines():
            if line.strip():
                token, rank = line.split()
                self.rank[base64.b64decode(token).decode("latin-1")] = int(rank)
        if missing := [b for b in range(256) if chr(b) not in self.rank]:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.text = {rank: token for token, rank in self.rank.items()}
        self.bytes = {rank: token.encode("latin-1") for rank, token in self.text.items()}
        self.decimal = {rank: str(rank) for rank in self.text}
        self.longest = max(map(len, self.rank))
        self.trie = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.trie.add_word(token, rank)
        self.split = regex.compile(pattern)
        self.history = Memo(self._history, len(self.rank))
        self.fits = Memo(self._fits, MEMO_ENTRIES)
        self.pieces = Memo(self._piece, MEMO_ENTRIES)

    def _history(self, token: int) -> tuple[list[tuple[int, str, str]], bool]:
        """The merges inside a token as (rank, first part, last part) after each, and whether they rebuild it."""
        parts, steps = list(self.text[token]), []
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
        return steps, len(parts) == 1

    def _fits(self, pair: int) -> bool:
        """Whether two adjacent tokens stay apart: no merge across their border comes before those inside them."""
        left, right = divmod(pair, SHIFT)
        inside, whole = self.history[right]
        if left == SHIFT - 1 or not whole:  # nothing before it
            return whole
        before, a, b = self.history[left][0], self.text[left], self.text[right]
        if a + b in self.rank:
            return False
        i, j, x, y = 0, 0, a[-1], b[0]
        while True:
            across = self.rank.get(x + y, NEVER)
            next_left = before[i][0] if i < len(before) else NEVER
            next_right = inside[j][0] if j < len(inside) else NEVER
            if across < next_left and across <= next_right:
                return False
            if next_left <= next_right:
                if next_left == NEVER:
                    return True
                x = before[i][2]
                i += 1
            else:
                y = inside[j][1]
                j += 1

    def _backtrack(self, text: str) -> list[int]:
        ids, fits, prefix, longest = self.rank.get, self.fits, self.trie.longest_prefix, self.longest
        found: list[int] = []
        at, end, before = 0, len(text), SHIFT - 1
        dead = set()
        size = prefix(text[:longest])
        while at < end:
            while size:
                token = ids(text[at : at + size])
                if token is not None and at + size not in dead and fits[before * SHIFT + token]:
                    break
                size -= 1
            if size:
                found.append(token)
                before = token
                at += size
                size = prefix(text[at : at + longest])
            else:
                dead.add(at)
                size = len(self.text[found.pop()])
                before = found[-1] if found else SHIFT - 1
                at -= size
                size -= 1
        return found

    def _piece(self, piece: str) -> tuple[int, ...]:
        text = piece.encode("utf-8").decode("latin-1")
        whole = self.rank.get(text)
        return (whole,) if whole is not None else tuple(self._backtrack(text))

    def encode_chunks(self, text: str) -> Iterator[list[int]]:
        """Token ids of the whole text, a bounded number of pre-tokens at a time."""
        matches = (m.group() for m in self.split.finditer(text)) if len(text) > CHUNK else iter(self.split.findall(text))
        while pieces := list(islice(matches, CHUNK)):
            if len(max(pieces, key=len)) <= MEMO_CHARS:
                yield list(chain.from_iterable(map(self.pieces.__getitem__, pieces)))
            else:
                yield list(chain.from_iterable(self.pieces[p] if len(p) <= MEMO_CHARS else self._piece(p) for p in pieces))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encode_chunks(text)))

    def forget(self) -> None:
        """Give the memory of what texts taught back; the vocabulary stays."""
        self.pieces.forget()
        self.fits.forget()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_CODECS: dict[tuple[str, str], BytePairCodec] = {}


def codec(rank_lines: bytes, pattern: str) -> BytePairCodec:
    """The codec of a rank file, made once in each Python process."""
    key = (hashlib.sha256(rank_lines).hexdigest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = BytePairCodec(rank_lines, pattern)
    return _CODECS[key]


def rank_file(path: str) -> bytes:
    """The rank file's bytes, read on the driver: one vocabulary, a few hundred kB."""
    with open(path, "rb") as f:
        return f.read()


OUTPUTS = {
    "n_tokens": T.LongType(),
    "token_ids": T.ArrayType(T.IntegerType()),
    "decoded": T.BinaryType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def transcode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    outputs: tuple[str, ...] = ("n_tokens", "token_ids"),
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Encode each whole ``text`` and decode the ids again.

    Returns ``keep`` and any of ``OUTPUTS``: the number of tokens, the ids, the bytes
    decoded from them, or SHA-256 digests of ids (decimal, joined by commas) and of
    decoded bytes.  One narrow pass, no shuffle; null text counts as empty; repeated
    rows and null ids stay as they are; other columns are left out, so their names
    cannot clash.  A worker holds one Arrow batch and memos of bounded size.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    lines = spark.sparkContext.broadcast(rank_file(ranks_path))
    schema = T.StructType([docs.schema[k] for k in keep] + [T.StructField(o, OUTPUTS[o]) for o in outputs])
    names, wanted = list(keep), set(outputs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(lines.value, pattern)
        for batch in batches:
            rows: dict[str, list] = {o: [] for o in outputs}
            for value in batch["__text"]:
                n, ids, raw = 0, [], []
                ids_hash, raw_hash = hashlib.sha256(), hashlib.sha256()
                for part in bpe.encode_chunks(value or ""):
                    if "ids_sha256" in wanted:
                        ids_hash.update((("," if n else "") + ",".join(map(bpe.decimal.__getitem__, part))).encode())
                    n += len(part)
                    if "token_ids" in wanted:
                        ids += part
                    if wanted & {"decoded", "decoded_sha256"}:
                        back = bpe.decode(part)
                        raw_hash.update(back)
                        if "decoded" in wanted:
                            raw.append(back)
                made = {"n_tokens": n, "token_ids": ids, "decoded": b"".join(raw), "ids_sha256": ids_hash.hexdigest(), "decoded_sha256": raw_hash.hexdigest()}
                for o in outputs:
                    rows[o].append(made[o])
            yield pd.DataFrame({k: batch[k] for k in names} | rows)
        bpe.forget()

    return docs.select(*keep, docs[text].alias("__text")).mapInPandas(lean(run), schema)
