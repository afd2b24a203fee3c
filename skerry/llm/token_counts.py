"""Token counts of whole texts, with overlap resynchronisation for huge ones.

Texts above `huge` characters are encoded as overlapping chunks with offsets.
Two neighbouring encodings are spliced at a position that is a proven boundary
of the tokenizer and around which both encodings agree token by token; where
no such position lies inside the overlap, the overlap is widened, in the end
over everything since the last splice.

Why a position is proven: the vocabulary's splitter never matches across white
space, a digit is always a match of its own, added tokens hold neither, and no
ASCII white space or digit takes part in the canonical composition of the
characters before it. Whatever stands left of an ASCII space or digit therefore
cannot change a token from there on. The same fact lets shorter texts share the
counts of their white-space separated pieces: each distinct piece is encoded by
the library once per worker as long as it is remembered. Not every vocabulary has
such a splitter: `cuts_hold` tries each cut between characters of all kinds when
a file is loaded, and texts of a vocabulary that fails are encoded whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame

from skerry.llm.shared import keyed_texts, map_texts

# Characters before which a cut is proven; fixed by the splitter of the vocabulary.
CUTS = frozenset(" \t\n\r0123456789")
HUGE_CHARS = 65_536
OVERLAP_CHARS = 512
# Pieces remembered per worker; beyond it the memory starts anew.
MEMO_PIECES = 250_000

Token = tuple[int, int, int]


def load_tokenizer(path: str):
    """The tokenizer of a .json vocabulary as the library gives it, without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# What stands on either side of a cut when it is tried: letters, marks, digits, signs, white space and their mixtures.
PROBES = ("a", "Ab", "the", "é", "e\u0301", "漢字", "ß", "5", "12", "!", "?!", "...", "'s", "x'", "<|", "_", "\u00a0", " ", "\n\n", "a b", "😀", "")


def cuts_hold(tokenizer) -> bool:
    """Whether tokens never reach over the cuts, and pieces between white space are counted apart, for all probes."""
    ids = lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for cut in sorted(CUTS):
        pairs = [(left, cut + right) for left in PROBES for right in PROBES]
        whole, lefts, rights = ids([a + b for a, b in pairs]), ids([a for a, _ in pairs]), ids([b for _, b in pairs])
        if any(w != a + b for w, a, b in zip(whole, lefts, rights)):
            return False
        if cut.isspace() and any(r != b for r, b in zip(rights, ids([b[1:] for _, b in pairs]))):
            return False
    return True


def token_offsets(tokenizer, text: str, start: int, end: int) -> list[Token]:
    """(start, end, id) of the tokens of text[start:end], positions counted in the whole text."""
    found = tokenizer.encode(text[start:end], add_special_tokens=False)
    return [(a + start, b + start, i) for (a, b), i in zip(found.offsets, found.ids)]


def _inside(tokens: list[Token], start: int, end: int) -> list[Token]:
    return tokens[bisect_left(tokens, (start,)) : bisect_left(tokens, (end,))]


def common_cut(text: str, left: list[Token], right: list[Token], start: int, end: int) -> int | None:
    """A proven cut inside the overlap [start, end) after a stretch on which both encodings agree.

    The stretch reaches from the first to the last proven position of the
    overlap and holds at least one token; no token may reach over the cut.
    """
    first = next((p for p in range(start + 1, end) if text[p] in CUTS), None)
    last = next((p for p in range(end - 1, start, -1) if text[p] in CUTS), None)
    if first is None or first >= last:
        return None
    agreed = _inside(left, first, last)
    if not agreed or agreed != _inside(right, first, last) or agreed[-1][1] > last:
        return None
    return last


def count_resynchronised(
    tokenizer, text: str, chunk: int = HUGE_CHARS, overlap: int = OVERLAP_CHARS, widened: list[int] | None = None
) -> int:
    """Tokens of a whole text from overlapping chunks; `widened` collects the overlaps that had to grow."""
    size, total, cut = len(text), 0, 0
    end = min(size, chunk)
    left = token_offsets(tokenizer, text, 0, end)
    while end < size:
        reach, following = overlap, min(size, end + chunk)
        while True:
            start = max(cut, end - reach)
            right = token_offsets(tokenizer, text, start, following)
            found = common_cut(text, left, right, start, end)
            if found is not None or start == cut:
                break
            reach *= 4
            if widened is not None:
                widened.append(reach)
        if found is not None:
            total += len(_inside(left, cut, found))
            cut = found
        # Without a common cut the right encoding began at the last proven cut and replaces the left one.
        left, end = right, following
    return total + len(_inside(left, cut, size + 1))


@cache
def text_counter(path: str, chunk: int = HUGE_CHARS, overlap: int = OVERLAP_CHARS) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts with a bounded memory of pieces, one per Python worker."""
    tokenizer = load_tokenizer(path)
    if not cuts_hold(tokenizer):
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    known: dict[bytes, int] = {}

    def count(texts: list[str]) -> list[int]:
        if len(known) > MEMO_PIECES:
            known.clear()
        pieces = [[] if len(t) > chunk else t.encode().split() for t in texts]
        fresh = list({p for own in pieces for p in own if p not in known})
        if fresh:
            encoded = tokenizer.encode_batch([p.decode() for p in fresh], add_special_tokens=False)
            known.update(zip(fresh, map(len, encoded)))
        look = known.__getitem__
        return [
            count_resynchronised(tokenizer, t, chunk, overlap) if len(t) > chunk else sum(map(look, own))
            for t, own in zip(texts, pieces)
        ]

    return count


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = HUGE_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    A NULL or empty text has 0 tokens, NULL identifiers and repeated rows stay
    as they are, an empty table gives an empty result, other columns are not
    looked at. `vocabulary` is a file every executor sees under the same path.
    """

    def make():
        counter = text_counter(vocabulary, chunk, overlap)
        return lambda texts: [(len(t.encode()), n, n > limit) for t, n in zip(texts, counter(texts))]

    return map_texts(keyed_texts(docs, id_col, text_col), make, "n_bytes bigint, n_tokens bigint, over_limit boolean")
