"""Byte-level BPE by the ranks of a rank file, through the tokenizers library.

The rank file lists tokens as bytes. The library works on characters, so every
byte stands for one printable character (`byte_characters`) and a token for a
short string. The rank file has no merge list: every split of a token into two
tokens becomes a merge, in the order of the ranks, which is what merging by the
rank of the joined bytes means. A word that is a token itself is taken whole.
Ambiguous ties (two splits of one token overlapping in a word) are compared
with the reference library in the tests.

Texts are cut before white space that follows something else; no match of the
splitting pattern lies across such a position and none looks behind it. Each
distinct piece is encoded by the library once per worker while it is remembered.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cache

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from skerry.llm.shared import keyed_texts, map_texts

# White space of the splitting pattern (Unicode White_Space); fixed values.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
WHITE_CHARACTERS = frozenset(chr(c) for c in range(0x3001) if re.match(f"[{WHITE}]", chr(c)))
# Pieces remembered per worker and generation, and pieces encoded as one text.
MEMO_PIECES = 75_000
CHAIN_PIECES = 20_000


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one above 255, in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = set(plain)
    table, above = [], 256
    for byte in range(256):
        if byte in shown:
            table.append(chr(byte))
        else:
            table.append(chr(above))
            above += 1
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a local path or a file system URI."""
    system, name = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    with system.open_input_stream(name) as source:
        lines = source.read().split(b"\n")
    return {base64.b64decode(line.split()[0]): int(line.split()[1]) for line in lines if line.strip()}


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        self.characters = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(self.characters)}
        shown = str.maketrans({b: c for b, c in enumerate(self.characters)})
        text = {token: token.decode("latin-1").translate(shown) for token in ranks}
        merges = [
            (text[token[:cut]], text[token[cut:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        vocabulary = {text[token]: rank for token, rank in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        # The way back: the characters of each token through the byte table.
        self.bytes_of = {rank: bytes(self.byte_of[c] for c in token) for token, rank in vocabulary.items()}
        self.bytes_named = {str(rank): token for rank, token in self.bytes_of.items()}

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_with_offsets(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(id, first byte, end byte, first character, end character); tokens of one split character share its offsets."""
        found, at, out = self.tokenizer.encode(text, add_special_tokens=False), 0, []
        for token, (first, end) in zip(found.ids, found.offsets):
            out.append((token, at, at + len(self.bytes_of[token]), first, end))
            at += len(self.bytes_of[token])
        return out

    def offsets(self, text: str, ids: list[int]) -> list[tuple[int, int, int, int, int]]:
        """`encode_with_offsets` for ids that are there: bytes by adding up tokens, characters by counting their first bytes."""
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids], dtype=np.int64)
        starts = ends - [len(self.bytes_of[i]) for i in ids]
        number = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
        return list(zip(ids, starts.tolist(), ends.tolist(), (number[starts] - 1).tolist(), number[ends - 1].tolist())) if ids else []

    def decode_listed(self, listed: str) -> bytes:
        """The bytes of decimal ids joined by commas."""
        return b"".join(map(self.bytes_named.__getitem__, listed.split(","))) if listed else b""

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text; bytes of a character whose other tokens are missing become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


class Pieces:
    """Encoded pieces of texts, remembered: their ids as listed text, and the bytes decoded from the ids.

    What was used since the last change of generation stays; the rest of the
    older one goes when the newer one is full.
    """

    def __init__(self, codec: ByteBpe) -> None:
        self.codec = codec
        self.listed: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.older: tuple[dict[str, str], dict[str, bytes]] = ({}, {})

    def split(self, texts: list[str]) -> list[list[str]]:
        """The pieces of each text, all of them known afterwards."""
        if len(self.listed) > MEMO_PIECES:
            self.older, self.listed, self.decoded = (self.listed, self.decoded), {}, {}
        pieces = list(map(PIECES.findall, texts))
        listed, decoded = self.older
        fresh = []
        for piece in {p for own in pieces for p in own if p not in self.listed}:
            if piece in listed:
                self.listed[piece], self.decoded[piece] = listed[piece], decoded[piece]
            else:
                fresh.append(piece)
        # Between a character that is no white space and white space the splitting pattern always cuts, so pieces
        # of that kind are encoded as one text and told apart by their bytes.
        chained = [p for p in fresh if p[0] in WHITE_CHARACTERS and p[-1] not in WHITE_CHARACTERS]
        for start in range(0, len(chained), CHAIN_PIECES):
            self._learn_chain(chained[start : start + CHAIN_PIECES])
        single = [p for p in fresh if p not in self.listed]
        for piece, ids in zip(single, self.codec.encode_batch(single) if single else ()):
            self.listed[piece], self.decoded[piece] = ",".join(map(str, ids)), self.codec.decode_bytes(ids)
        return pieces

    def _learn_chain(self, chain: list[str]) -> None:
        ids = self.codec.encode_batch(["".join(chain)])[0]
        tokens, names = list(map(self.codec.bytes_of.__getitem__, ids)), list(map(str, ids))
        ends = np.cumsum([len(t) for t in tokens])
        edges = np.searchsorted(ends, np.cumsum([len(p.encode()) for p in chain])) + 1
        first = 0
        for piece, end in zip(chain, edges.tolist()):
            self.listed[piece], self.decoded[piece] = ",".join(names[first:end]), b"".join(tokens[first:end])
            first = end

    def encode(self, text: str) -> list[int]:
        """The ids of a text, put together from its pieces."""
        own = self.split([text])[0]
        return [int(i) for piece in own for i in self.listed[piece].split(",")]


@cache
def pieces_of(path: str, pattern: str) -> Pieces:
    """One codec per Python worker, kept from task to task."""
    return Pieces(ByteBpe(path, pattern))


def round_trip(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
    keep_offsets: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (bytes decoded from those ids).

    With `keep_ids` the ids follow as an array, with `keep_offsets` an array of
    (id, start, end, first, last): bytes, then characters, ends exclusive; tokens
    of one split character share its characters. A NULL text is the empty text: no
    tokens, the hash of nothing twice.
    """

    def make():
        pieces = pieces_of(vocabulary, pattern)

        def work(texts: list[str]) -> list[tuple]:
            rows = []
            for text, own in zip(texts, pieces.split(texts)):
                listed = ",".join(map(pieces.listed.__getitem__, own))
                decoded = pieces.codec.decode_listed(listed)
                row = [listed.count(",") + 1 if listed else 0]
                row += [hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()]
                ids = list(map(int, listed.split(","))) if listed and (keep_ids or keep_offsets) else []
                if keep_ids:
                    row.append(ids)
                if keep_offsets:
                    row.append([dict(zip(OFFSET, found)) for found in pieces.codec.offsets(text, ids)])
                rows.append(tuple(row))
            return rows

        return work

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<bigint>" * keep_ids
    schema += f", offsets array<struct<{', '.join(f'{name}: bigint' for name in OFFSET)}>>" * keep_offsets
    return map_texts(keyed_texts(docs, id_col, text_col), make, schema)


OFFSET = ("id", "start", "end", "first", "last")
