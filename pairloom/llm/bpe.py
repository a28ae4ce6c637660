"""Byte-level BPE encoding and decoding of whole texts, long unsplit text by tree concatenation.

The tokenizer's pattern splits a text into pieces, and each piece is encoded on its own.  A
space between two characters that are not white space always begins a piece, so a long text is
cut there into chunks which are encoded in parallel and simply appended.  A stretch without such
a place is *unsplit*: its halves are cut anywhere and encoded in parallel, and a join then

1. keeps the pieces of both sides that the cut cannot have touched, splits a growing window
   around the join again until it meets a piece start of the right side, and
2. where two halves of one piece meet, encodes a growing window of tokens around the join
   again until its first and last tokens equal those of both sides.

Step 2 is exact: a token sequence is the encoding of its text if and only if every two
neighbours are, and with agreement at both ends every pair lies inside one of three encodings.

Null texts count as empty and have no tokens.  The string of a special token in a text becomes
that token.  Classes of characters beyond U+052F may depend on a library's version of Unicode:
texts with such characters are split into pieces by the tokenizers library's own rule, whole
texts, halves and windows around a join alike.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

CHUNK = 1 << 16  # code points of one chunk of a long text
LEAF = 2048  # a piece up to this length is encoded in one go
MAX_VOCABULARY_BYTES = 16 << 20
OTHER = re.compile("[^\x00-ԯ]")

# Fixed value: the byte-level split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder for one vocabulary, given as the text of its JSON file."""

    def __init__(self, vocabulary: str) -> None:
        names, spec = byte_names(), json.loads(vocabulary)
        ranks = {bytes(names[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.ranks = {b: i for b, i in ranks.items() if i not in self.special.values()}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens=self.special)
        self.bytes_of = [b""] * (1 + max([*self.ranks.values(), *self.special.values()]))
        for data, i in [*self.ranks.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes_of[i] = data
        self.split = regex.compile(PATTERN)
        self.vocabulary = vocabulary

    @functools.cached_property
    def exact(self) -> Tokenizer:
        tokenizer = Tokenizer.from_str(self.vocabulary)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    # Whole chunks.

    def chunk(self, text: str) -> list[int]:
        if OTHER.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")

    def decode(self, ids: np.ndarray | list[int]) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")

    # One piece.

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one piece, which may be very long."""
        if len(data) <= LEAF:
            return self.fast._encode_single_piece(data)
        half = len(data) // 2
        return self.join_tokens(self.piece(data[:half]), self.piece(data[half:]))

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of one piece from those of its two halves."""
        if not left or not right:
            return left or right
        reach = 4
        while True:
            a, b = left[-reach:], right[:reach]
            window = self.fast._encode_single_piece(b"".join(self.bytes_of[i] for i in a + b))
            whole_left, whole_right = len(a) == len(left), len(b) == len(right)
            if (whole_left or window[0] == a[0]) and (whole_right or window[-1] == b[-1]):
                return left[:len(left) - len(a)] + window + right[len(b):]
            reach *= 2

    # Unsplit text: pieces with their tokens.

    def split_text(self, text: str) -> list[str]:
        """The pieces of a text without special tokens."""
        if OTHER.search(text):
            return [text[start:end] for _, (start, end) in self.exact.pre_tokenizer.pre_tokenize_str(text)]
        return self.split.findall(text)

    def pieces(self, text: str) -> list[tuple[str, list[int]]]:
        """(piece, its tokens) of a text without special tokens."""
        return [(p, self.piece(p.encode())) for p in self.split_text(text)]

    def join_pieces(self, left: list, right: list) -> list:
        """The pieces of a text from those of its two parts.

        All but the last three pieces of the left part are out of reach of the cut, because a
        match looks at most one character beyond itself and the longest fixed ones have three.
        """
        if not left or not right:
            return left or right
        tail = left[-3:]
        take = 4
        while True:
            head = right[:take]
            seam = "".join(p for p, _ in tail)
            window = self.split_text(seam + "".join(p for p, _ in head))
            starts, at = {}, len(seam)
            for k, (p, _) in enumerate(head):
                starts[at] = k
                at += len(p)
            last = len(head) == len(right)
            sure = window if last else window[:-3]
            at, done = 0, []
            for p in sure:
                if at in starts and at > len(seam):
                    return left[:-3] + done + right[starts[at]:]
                done.append((p, self._joined_piece(p, at, seam, tail, head)))
                at += len(p)
            if last:
                return left[:-3] + done
            take *= 2

    def _joined_piece(self, piece: str, at: int, seam: str, tail: list, head: list) -> list[int]:
        """Tokens of a piece of the window; its two halves are joined where both are known."""
        cut = len(seam) - at
        if 0 < cut < len(piece) and tail[-1][0] == piece[:cut] and head[0][0] == piece[cut:]:
            return self.join_tokens(tail[-1][1], head[0][1])
        return self.piece(piece.encode())

    def unsplit(self, text: str) -> list:
        """Pieces of a stretch, by halves."""
        if len(text) <= LEAF:
            return self.pieces(text)
        half = len(text) // 2
        return self.join_pieces(self.unsplit(text[:half]), self.unsplit(text[half:]))


CUT = re.compile(r"\S(?= \S)")
RUN = re.compile(rf"\S{{{LEAF},}}|\s{{{LEAF},}}")


def chunks_of(text: str, special: list[str], size: int = CHUNK) -> list[tuple[str, bool]]:
    """The text in chunks of about ``size``; the flag says that the cut before it is not a sure one.

    Cuts go where a piece is sure to begin.  Where none comes for another ``size``, the stretch
    is unsplit and cut anywhere, unless it holds a special token.
    """
    out, at, free = [], 0, False
    while len(text) - at > size:
        found = CUT.search(text, at + size)
        end = found.end() if found else len(text)
        stretch = text[at:end]
        if end - at > 2 * size and not any(s in stretch for s in special):
            for start in range(0, len(stretch), size):
                out.append((stretch[start:start + size], free or start > 0))
        else:
            out.append((stretch, free))
        at = end
    if at < len(text) or not out:
        out.append((text[at:], False))
    return out


def encode_chunk(bpe: ByteBpe, text: str) -> list[int]:
    """Tokens of a chunk; stretches with a very long run go by tree concatenation."""
    if len(text) <= LEAF or not RUN.search(text):
        return bpe.chunk(text)
    out: list[int] = []
    specials = "|".join(map(re.escape, bpe.special)) or r"(?!)"
    for part in re.split(f"({specials})", text):
        if part in bpe.special:
            out.append(bpe.special[part])
        else:
            for _, tokens in bpe.unsplit(part):
                out += tokens
    return out


def join_all(bpe: ByteBpe, parts: list[list]) -> list:
    """Pieces of neighbouring parts joined as a tree."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return bpe.join_pieces(join_all(bpe, parts[:half]), join_all(bpe, parts[half:]))


@functools.lru_cache(maxsize=2)
def _loaded(vocabulary: str) -> ByteBpe:
    return ByteBpe(vocabulary)


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def encode_texts(docs: DataFrame, text: str, vocabulary_path: str, out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text, as little-endian unsigned 32-bit integers; an own column ``out`` gives way.

    Texts of one chunk are encoded where they are.  Longer ones are cut into chunks, which
    are dealt to all tasks, and put together again per document; see ``encode_long``.
    """
    vocabulary = load_vocabulary(docs.sparkSession, vocabulary_path)
    column = F.col(f"`{text}`")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out or c == text])
    keyed = docs.withColumn("__llm_long", F.coalesce(F.length(column) > CHUNK, F.lit(False)))
    short = keyed.where(~F.col("__llm_long")).drop("__llm_long").withColumn(out, _encoder(vocabulary)(F.coalesce(column, F.lit(""))))
    return short.unionByName(encode_long(keyed.where("__llm_long").drop("__llm_long"), text, vocabulary, out))


def load_vocabulary(spark, path: str):
    """The JSON text of a vocabulary, checked for size, as a broadcast."""
    with open(path, encoding="utf-8") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is too large to broadcast")
    return spark.sparkContext.broadcast(content)


def _encoder(vocabulary):
    @F.arrow_udf("binary")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _loaded(vocabulary.value)
        for batch in texts:
            yield by_slices(batch, pa.binary(), lambda t: packed(encode_chunk(bpe, t or "")))

    return encode


def by_slices(batch: pa.Array, kind: pa.DataType, each) -> pa.Array:
    """``each`` of every value; few results at a time are Python objects, the rest is in Arrow buffers."""
    done = [pa.array([each(v.as_py()) for v in batch.slice(at, 200)], kind) for at in range(0, len(batch), 200)]
    return pa.concat_arrays(done) if done else pa.array([], kind)


def encode_long(docs: DataFrame, text: str, vocabulary, out: str, size: int = CHUNK) -> DataFrame:
    """Long texts: one row per chunk, encoded anywhere, put together in order per document."""
    @F.arrow_udf("array<struct<chunk: string, free: boolean>>")
    def cut(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        special = list(_loaded(vocabulary.value).special)
        kind = pa.list_(pa.struct([("chunk", pa.string()), ("free", pa.bool_())]))
        for batch in texts:
            yield pa.array([[{"chunk": c, "free": f} for c, f in chunks_of(t.as_py() or "", special, size)]
                            for t in batch], kind)

    @F.arrow_udf("struct<ids: binary, sizes: array<int>>")
    def encode(chunks: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        """Token ids; beside an unsure cut also how many tokens each piece has."""
        bpe = _loaded(vocabulary.value)
        for texts, seams in chunks:
            ids, sizes = [], []
            for t, seam in zip(texts, seams, strict=True):
                pieces = bpe.unsplit(t.as_py()) if seam.as_py() else None
                ids.append(packed(encode_chunk(bpe, t.as_py()) if pieces is None else [i for _, p in pieces for i in p]))
                sizes.append(None if pieces is None else [len(p) for _, p in pieces])
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(sizes, pa.list_(pa.int32()))],
                                             ["ids", "sizes"])

    @F.arrow_udf("binary")
    def assemble(documents: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _loaded(vocabulary.value)
        for batch in documents:
            yield pa.array([_assembled(bpe, d.as_py()) for d in batch], pa.binary())

    others = [c for c in docs.columns if c != text]
    rest = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_"))
    keyed = docs.withColumn("__llm_row", F.monotonically_increasing_id()).withColumn("__llm_chunks", cut(F.col(f"`{text}`")))
    chunks = keyed.select("__llm_row", rest.alias("__llm_rest"), "__llm_chunks", F.posexplode("__llm_chunks").alias("__llm_no", "__llm_c"))
    # The other columns travel with the first chunk only.
    after = F.coalesce(F.try_element_at("__llm_chunks", F.col("__llm_no") + 2)["free"], F.lit(False))
    chunks = chunks.select("__llm_row", "__llm_no", F.when(F.col("__llm_no") == 0, F.col("__llm_rest")).alias("__llm_rest"), "__llm_c.chunk", "__llm_c.free",
                           (F.col("__llm_c.free") | after).alias("seam"))
    encoded = chunks.repartition("__llm_row", "__llm_no").withColumn("__llm_e", encode("chunk", "seam"))
    part = F.struct("__llm_no", "chunk", "free", F.col("__llm_e.ids").alias("ids"), F.col("__llm_e.sizes").alias("sizes"))
    # The parts of one document, which is one result row.
    whole = encoded.groupBy("__llm_row").agg(
        F.array_sort(F.collect_list(part)).alias("__llm_parts"), F.first("__llm_rest", ignorenulls=True).alias("__llm_rest"))
    joined = F.array_join(F.transform("__llm_parts", lambda p: p["chunk"]), "")
    return whole.select(*[(joined if c == text else F.col(f"__llm_rest.`{c}`")).alias(c) for c in docs.columns],
                        assemble(F.transform("__llm_parts", lambda p: p.dropFields("chunk"))).alias(out))


def _assembled(bpe: ByteBpe, parts: list[dict]) -> bytes:
    """Ids of a document from those of its chunks; chunks on both sides of unsure cuts are joined."""
    out, at = [], 0
    while at < len(parts):
        end = at + 1
        while end < len(parts) and parts[end]["free"]:
            end += 1
        if end == at + 1:
            out.append(parts[at]["ids"])
        else:
            run = []
            for part in parts[at:end]:
                ids, pieces, i = np.frombuffer(part["ids"], "<u4").tolist(), [], 0
                for n in part["sizes"]:
                    tokens = ids[i:i + n]
                    pieces.append((b"".join(bpe.bytes_of[t] for t in tokens).decode(), tokens))
                    i += n
                run.append(pieces)
            out.append(packed([i for _, tokens in join_all(bpe, run) for i in tokens]))
        at = end
    return b"".join(out)


def decode_ids(encoded: DataFrame, ids: str, vocabulary_path: str, out: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for; invalid UTF-8 becomes U+FFFD."""
    vocabulary = load_vocabulary(encoded.sparkSession, vocabulary_path)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _loaded(vocabulary.value)
        for batch in batches:
            yield by_slices(batch, pa.string(), lambda b: bpe.decode(np.frombuffer(b or b"", "<u4").tolist()))

    return encoded.withColumn(out, decode(F.col(f"`{ids}`")))
