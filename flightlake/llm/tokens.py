"""Token counts by the whole-token shortcut.

Offline, on the driver, :func:`prove_whole_tokens` asks the vocabulary's own merge model which of
its word-final strings encode alone as exactly one token. A text is cut at ASCII white space, which
always ends a pre-token; a cut piece is normalised and pre-tokenised as the library does it; each
pre-token in the proven set counts one, and only the others go through the merges. Counts of pieces
already seen are kept in a bounded table per worker.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows
are counted each; an empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import columns, ship

#: Pieces whose counts a worker keeps; the table is emptied beyond that.
KEPT_PIECES = 300_000
#: A text is cut into blocks of about so many bytes, at white space.
BLOCK = 1 << 20
WORD_END = "</w>"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Fixed value: the vocabulary's own pre-token pattern, for lower-cased text of printable ASCII and ``letters``.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z{letters}]+|[0-9]|[^ a-z0-9{letters}]+"
#: Code points among which letters that behave like ASCII letters are looked for.
LATIN = range(0xA1, 0x250)
_LOADED: dict[int, Tokenizer] = {}


@dataclass(frozen=True)
class Proof:
    """What the shortcut may rely on, established against the library itself."""

    source: str
    whole: frozenset[str]
    letters: str
    any_case: str


def prove_whole_tokens(source: str) -> Proof:
    """Pre-tokens that encode as exactly one token; letters that stay single under normalisation,
    lower-case as Python does, and never split a run of letters."""
    tokenizer = Tokenizer.from_str(source)
    model, split, normal = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.normalizer.normalize_str
    single = (v[: -len(WORD_END)] for v in tokenizer.get_vocab(with_added_tokens=False) if v.endswith(WORD_END))
    whole = frozenset(h for h in single if h and len(model.tokenize(h)) == 1)
    good = [c for c in map(chr, LATIN) if normal(c) == c.lower() and len(c.lower()) == 1
            and all(len(split(f"{x}{c.lower()}{y}")) == 1 for x in ("a", c.lower()) for y in ("b", "\xe9"))]
    lower = {c.lower() for c in good}
    lower = {c for c in lower if normal(c) == c}
    return Proof(source, whole, "".join(sorted(lower)), "".join(sorted(c for c in good if c.lower() in lower)))


def _byte_level(text: str) -> str:
    return "".join(map(_BYTE_LEVEL.__getitem__, text.encode()))


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet's rule: printable Latin-1 bytes stand for themselves, the others
    follow in order from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_BYTE_LEVEL = _byte_alphabet()


def _tokenizer(text: str) -> Tokenizer:
    key = hash(text)
    if key not in _LOADED:
        _LOADED[key] = Tokenizer.from_str(text)
    return _LOADED[key]


class PreTokenCounts(dict):
    """Pre-token in the byte-level alphabet -> tokens: one if proven whole, else by the merges."""

    def __init__(self, tokenizer: Tokenizer, whole: frozenset[str]):
        super().__init__()
        self.model, self.whole = tokenizer.model, whole

    def __missing__(self, part: str) -> int:
        n = self[part] = 1 if part in self.whole else len(self.model.tokenize(part))
        return n


class PieceCounts(dict):
    """Piece without ASCII white space -> number of tokens."""

    def __init__(self, proof: Proof):
        super().__init__()
        self.tokenizer = _tokenizer(proof.source)
        self.parts = PreTokenCounts(self.tokenizer, proof.whole)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.easy = re.compile(f"[!-~{proof.any_case}]+").fullmatch
        self.pretokens = re.compile(PRETOKENS.format(letters=proof.letters)).findall

    def __missing__(self, piece: bytes) -> int:
        text = piece.decode()
        if any(s in text for s in self.special):  # found in raw text before anything else
            n = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        elif self.easy(text):
            found = self.pretokens(text.lower())
            n = sum(self.parts[p if p.isascii() else _byte_level(p)] for p in found)
        else:
            text = self.tokenizer.normalizer.normalize_str(text)
            n = sum(self.parts[p] for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))
        self[piece] = n
        return n

    def of(self, text: bytes) -> int:
        total = 0
        for block in blocks(text):
            total += sum(map(self.__getitem__, block.split()))
            if len(self) > KEPT_PIECES:
                self.clear()
            if len(self.parts) > KEPT_PIECES:
                self.parts.clear()
        return total


def blocks(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """The text in blocks that end at ASCII white space."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at, at + size) for c in (b" ", b"\n", b"\t", b"\r"))
        if cut < at:
            cut = min((x for c in (b" ", b"\n", b"\t", b"\r") if (x := text.find(c, at + size)) >= 0), default=len(text))
        yield text[at: cut + 1]
        at = cut + 1
    yield text[at:]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, and whether the tokens exceed ``limit``.

    ``vocabulary`` is the path of a ``tokenizers`` JSON file on the driver. It is sent to the
    executors together with the proven strings (a few MB, fixed by the file)."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as f:
        source = f.read()
    sent = spark.sparkContext.broadcast(prove_whole_tokens(source))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PieceCounts(sent.value)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            tokens = [counts.of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(count, SCHEMA)
