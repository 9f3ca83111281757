"""Byte-level BPE as a tree reduction over an encoding monoid, and its inverse.

A text is cut by the tokenizer's pattern; each match is encoded by itself. Within a match,
the halves are encoded recursively and joined: the last tokens of the left half and the first
of the right are merged anew over their bytes, and the window grows on a side until the
tokens next to it stay as they are. That is decided by pairs: a row of tokens is the encoding
of its bytes exactly when every two neighbours are the encoding of theirs. Pairs inside the
halves and inside the window already are, so only the two seams need to be looked at. The
join is associative (both ways give the encoding of all bytes), which is what lets a long
match be reduced as a tree. Decoding concatenates the tokens' bytes up the same tree.

Defined results. A null text is empty: no ids, the digests of nothing. Rows are independent,
so repeated rows repeat their result, and an empty table gives no rows. Special tokens'
strings are ordinary text. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm.common import smaller_batches, table

LEAF_BYTES = 4
# Entries of a generation of a worker's memories, see Memory.
CACHE_CHUNKS = 500_000
CACHE_PAIRS = 200_000
CACHE_PARTS = 200_000
PART_BYTES = 12
CODES = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Memory:
    """A bounded dictionary in two generations.

    When the young one is full it becomes the old one, which is dropped; what is found in the
    old one moves to the young one. So what is met often stays, and nothing is counted.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value

    def clear(self) -> None:
        self.young, self.old = {}, {}


LETTERS = "".join(chr(c) for c in range(65, 256) if chr(c).isalpha() and c not in (170, 181, 186))
PLAIN = re.compile(f"([{LETTERS}]+)([.,]?)")


class BytePairs:
    """Encoder and decoder for the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_bytes: int = LEAF_BYTES):
        self.ranks, self.leaf_bytes = ranks, leaf_bytes
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        # A space and letters are one match of most patterns, a comma or stop behind them
        # another one; then they need no search.
        plain = [[" " + letters, *sign] for letters in (LETTERS * 9, *LETTERS) for sign in ("", ",", ".")]
        self.plain_match = all(self.pattern.findall("".join(x)) == x for x in plain)
        self.stable, self.parts = Memory(CACHE_PAIRS), Memory(CACHE_PARTS)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> BytePairs:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        return cls(ranks, pattern)

    def merge(self, data: bytes) -> list[bytes]:
        """Encodes by repeatedly joining the neighbours of lowest rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def holds(self, left: bytes, right: bytes) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        pair = (left, right)
        known = self.stable.get(pair)
        if known is None:
            known = self.merge(left + right) == [left, right]
            self.stable.put(pair, known)
        return known

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of both sides' bytes, from the encodings of the sides."""
        if not left or not right or self.holds(left[-1], right[0]):
            return left + right
        i, j = 1, 1  # tokens in the window, counted from the seam
        while True:
            window = self.known(b"".join(left[-i:]) + b"".join(right[:j]), self.merge)
            left_ok = i >= len(left) or self.holds(left[-i - 1], window[0])
            right_ok = j >= len(right) or self.holds(window[-1], right[j])
            if left_ok and right_ok:
                return left[: len(left) - i] + window + right[j:]
            i = i if left_ok else min(2 * i, len(left))
            j = j if right_ok else min(2 * j, len(right))

    def known(self, data: bytes, encode) -> list[bytes]:
        """``encode(data)``, remembered for short data. Callers don't change the list."""
        if len(data) > PART_BYTES:
            return encode(data)
        found = self.parts.get(data)
        if found is None:
            found = encode(data)
            self.parts.put(data, found)
        return found

    def reduce(self, data: bytes) -> list[bytes]:
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        middle = len(data) // 2
        return self.join(self.known(data[:middle], self.reduce), self.known(data[middle:], self.reduce))

    def encode_match(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return [self.ranks[token] for token in self.reduce(data)]

    def encode(self, text: str) -> list[int]:
        return [i for match in self.pattern.findall(text) for i in self.encode_match(match.encode())]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 64:
            return b"".join([self.tokens[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


# White space beside a space, or a space at an end.
CROWDED = re.compile(r"\s | \s|^ | \Z")


def chunks(text: str) -> list[str]:
    """The text cut before every lone space that stands between two other characters.

    The tokenizer's pattern always ends a match there, so the chunks can be encoded one by
    one. What touches more white space than that stays together.
    """
    parts = text.split(" ")
    out = [parts[0]]
    for part in parts[1:]:
        last = out[-1]
        if part and last and not part[0].isspace() and not last[-1].isspace():
            out.append(" " + part)
        else:
            out[-1] = f"{last} {part}"
    return out


_loaded: dict[tuple[str, str], BytePairs] = {}
_chunks = Memory(CACHE_CHUNKS)  # (number of ids, the ids in decimal, the bytes they decode to)


def codec(path: str, pattern: str) -> BytePairs:
    """The codec of a file, loaded once in a worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = BytePairs.from_file(path, pattern)
        _chunks.clear()
    return _loaded[path, pattern]


def code(matches: list[str], pairs: BytePairs) -> tuple[int, str, bytes]:
    """Number of ids, the ids in decimal, the bytes they decode to."""
    ids = [i for match in matches for i in pairs.encode_match(match.encode())]
    return len(ids), ",".join(map(str, ids)), pairs.decode(ids)


def code_chunk(chunk: str, pairs: BytePairs) -> tuple[int, str, bytes]:
    """The codes of a space and ``chunk``, from memory where it was met before."""
    known = _chunks.get(chunk)
    if known is None:
        plain = PLAIN.fullmatch(chunk) if pairs.plain_match else None
        if not plain:
            known = code(pairs.pattern.findall(" " + chunk), pairs)
        elif not plain[2]:
            known = code([" " + chunk], pairs)
        else:
            word, sign = code_chunk(plain[1], pairs), code([plain[2]], pairs)
            known = word[0] + sign[0], f"{word[1]},{sign[1]}", word[2] + sign[2]
        if len(chunk) <= 200:
            _chunks.put(chunk, known)
    return known


def digests(text: str, pairs: BytePairs) -> tuple[int, str, str]:
    """Tokens, digest of the decimal ids, digest of the bytes the ids decode to.

    Chunks between lone spaces don't share a match, so a chunk met before is taken from a
    bounded memory of the worker. Its key leaves out the leading space, which all but a
    text's first chunk have.
    """
    if CROWDED.search(text):
        first, *rest = chunks(text)
        rest = [c[1:] for c in rest]
    else:
        first, *rest = text.split(" ")
    found = list(map(_chunks.young.get, rest))
    if None in found:
        found = [code_chunk(c, pairs) if known is None else known for c, known in zip(rest, found)]
    counts, ids, decoded = zip(code(pairs.pattern.findall(first), pairs), *found)
    ids_text = ",".join(filter(None, ids))
    return (
        sum(counts),
        hashlib.sha256(ids_text.encode()).hexdigest(),
        hashlib.sha256(b"".join(decoded)).hexdigest(),
    )


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document; nothing is shuffled."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = codec(path, pattern)
        for batch in smaller_batches(batches, 256):
            rows = [digests(t or "", pairs) for t in batch.column(1).to_pylist()]
            n, ids, decoded = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, CODES)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
