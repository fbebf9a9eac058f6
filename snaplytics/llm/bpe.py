"""Byte-level BPE encoding and decoding.

The merge rules of a rank file are rebuilt (each token's two parts are what merging by
lower ranks leaves of it) and given to the ``tokenizers`` library: split by the
vocabulary's pattern, map bytes to printable characters, merge. Documents go through
Arrow batches, one loaded tokenizer per Python worker.

Within a task every distinct piece of text is tokenized once: a single space between
two non-white characters always starts a new match of the pattern, so a text can be cut
there and the parts encoded on their own with the same ids. The memo of parts is
bounded and simply starts anew when full; nothing is cut or dropped.

``encode`` also gives character offsets (a token that holds only some bytes of a
character reports that whole character). ``decode_stream`` turns ids back into text
through the reversed byte table and holds back the bytes of a character that is split
between tokens until its last byte arrives.

Cases: null text is empty (no ids, the hash of no bytes); repeated rows give repeated
rows; an empty table gives an empty result; extra columns are not touched. A text of any
length is encoded whole.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MEMO_PARTS = 400_000    # distinct parts a worker remembers
NO_MERGE = 1 << 60


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable
    Latin-1, else the next free one from U+0100 on."""
    spare = iter(range(256, 512))
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def parts_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The pair whose merge makes ``token``."""
    parts, limit = [bytes([b]) for b in token], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], NO_MERGE), i) for i in range(len(parts) - 1))
        if rank >= limit:
            raise ValueError(f"token of rank {limit} can't be reached by merges")
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class ByteBpe:
    """A rank file's tokenizer: encode, encode with offsets, decode."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        shown = byte_characters()
        show = lambda token: "".join(shown[b] for b in token)
        merges = [tuple(map(show, parts_of(t, ranks))) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
        self.tokenizer = Tokenizer(models.BPE(vocab={show(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        byte_of = {c: b for b, c in enumerate(shown)}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in self.tokenizer.get_vocab().items()}
        self.memo: dict[str, bytes] = {}
        self.spans: dict[str, np.ndarray] = {}

    def encode(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and the character offsets each covers."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return found.ids, found.offsets

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [independent_parts(t) for t in texts]
        new = {p for parts in cut for p in parts if p not in self.memo}
        if len(self.memo) + len(new) > MEMO_PARTS:
            self.memo = {}
            new = {p for parts in cut for p in parts}
        new = list(new)
        for start in range(0, len(new), 20_000):
            some = new[start:start + 20_000]
            for part, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.memo[part] = little_endian(found.ids)
        out = [b"".join(map(self.memo.__getitem__, parts)) for parts in cut]
        if len(self.memo) > MEMO_PARTS:
            self.memo = {}
        return out

    def offsets_all(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The first character of each text's tokens and the one after their last (tokens that share a
        split character both cover it): offsets inside each part, moved by where the part begins."""
        cut = [independent_parts(t) for t in texts]
        new = [p for p in {p for parts in cut for p in parts} if p not in self.spans]
        if len(self.spans) + len(new) > MEMO_PARTS:
            self.spans = {}
            new = list({p for parts in cut for p in parts})
        for start in range(0, len(new), 20_000):
            some = new[start:start + 20_000]
            for part, found in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                self.spans[part] = np.array(found.offsets, np.int32).reshape(-1, 2)
        out = []
        for parts in cut:
            begins = np.cumsum([0, *map(len, parts)])[:-1]
            spans = [self.spans[p] + np.int32(b) for p, b in zip(parts, begins)]
            whole = np.concatenate(spans) if spans else np.empty((0, 2), np.int32)
            out.append((whole[:, 0], whole[:, 1]))
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text for each id in turn; a character split between tokens comes with its last byte."""
        partial = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for i in ids:
            yield partial.decode(self.bytes_of[i])
        yield partial.decode(b"", final=True)


def little_endian(ids: list[int]) -> bytes:
    a = array("I", ids)
    if a.itemsize != 4:
        raise RuntimeError("unsigned int isn't 32 bits wide here")
    if __import__("sys").byteorder == "big":
        a.byteswap()
    return a.tobytes()


def independent_parts(text: str) -> list[str]:
    """Cut before each single space that stands between two non-white characters."""
    pieces = text.split(" ")
    if len(pieces) == 1:
        return pieces if text else []
    out, open_part = [], pieces[0]
    for p in pieces[1:]:
        if p and open_part and not p[0].isspace() and not open_part[-1].isspace():
            out.append(open_part)
            open_part = " " + p
        else:
            open_part += " " + p
    out.append(open_part)
    return out


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, with_ids: bool = False,
                     with_offsets: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; on request also ids (little-endian), and starts and ends:
    each token's character offsets in the text."""
    path, pattern = path or default_vocabulary(), pattern or default_pattern()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        bpe = load(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                coded = bpe.encode_all([t or "" for t in some.column(1).to_pylist()])
                plain = [bpe.decode(memoryview(c).cast("I")) for c in coded]
                columns = [some.column(0), pa.array([len(c) // 4 for c in coded], pa.int64()),
                           pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                           pa.array([hashlib.sha256(p).hexdigest() for p in plain])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns, names = [*columns, pa.array(coded, pa.binary())], [*names, "ids"]
                if with_offsets:
                    spans = bpe.offsets_all([t or "" for t in some.column(1).to_pylist()])
                    columns += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                    names = [*names, "starts", "ends"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
        + ", ids binary" * with_ids + ", starts array<int>, ends array<int>" * with_offsets)


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and the text its ids spell (bytes that are no UTF-8 become U+FFFD)."""
    path, pattern = path or default_vocabulary(), pattern or default_pattern()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            texts = ["".join(bpe.decode_stream(memoryview(c or b"").cast("I"))) for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, text string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
