"""Secrets in texts: known shapes, and strings that a tokenizer can't shorten."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.common import col
from fleetlens.llm.tokens import RANKS, ranks_encoding

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20}
#: A hex run shorter than asked for can't hold a match, so only longer ones are looked at.
LONG_HEX = re.compile("[0-9a-f]{24,}")

#: Strings that the token-efficiency test looks at.
CANDIDATE = re.compile("[A-Za-z0-9+/_-]{20,}={0,2}")
LEAST_RANDOM = 20
#: What '/', '_', '-' and '+' join, and such parts that belong to no secret if tokens shorten them.
PART, PLAIN = re.compile("[A-Za-z0-9]+"), re.compile("[A-Za-z]?[a-z]{4,}")
#: Characters up to which marks, or a part that tokens do shorten, may lie between two odd ones.
GAP = 4
#: Characters per token at or below which a string counts as random.
RATIO = 2.0
#: Lengths of hexadecimal digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGESTS = (32, 40, 56, 64, 96, 128)
HEX_ONLY = re.compile("[0-9a-fA-F]+")
UUID = re.compile("(?<![A-Za-z0-9])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![A-Za-z0-9])")
#: Words and numbers joined by marks, or capitalised words in a row with a number at the end.
IDENTIFIER = re.compile("(?:[A-Za-z]+|[0-9]{1,8})(?:[-_/=+](?:[A-Za-z]+|[0-9]{1,8}))+|(?:[A-Z]?[a-z]{3,})+[0-9]{0,6}")
#: Words of an identifier that are long enough to tell.
WORD = re.compile("[A-Za-z]{4,}")


def short(text: str, ratio: float, ranks: str) -> bool:
    """True if tokens do not shorten ``text``."""
    return len(text) <= ratio * len(ranks_encoding(ranks).encode_ordinary(text))


def digest(text: str) -> bool:
    return len(text) in DIGESTS and bool(HEX_ONLY.fullmatch(text))


def known_string(text: str, ratio: float = RATIO, ranks: str = RANKS) -> bool:
    """True for digests, UUIDs and identifiers; random letters in the shape of an identifier are none."""
    if digest(text) or UUID.fullmatch(text):
        return True
    if not IDENTIFIER.fullmatch(text):
        return False
    words = WORD.findall(text)
    size = sum(map(len, words))
    return size < LEAST_RANDOM or size > ratio * sum(len(ranks_encoding(ranks).encode_ordinary(w)) for w in words)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the known shapes, leftmost and without overlap within a kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def has_word(text: str, ratio: float, ranks: str) -> bool:
    return any(PLAIN.fullmatch(part) and not short(part, ratio, ranks) for part in PART.findall(text))


def odd_parts(text: str, ratio: float, ranks: str) -> Iterator[tuple[int, int]]:
    """Where neighbouring parts that tokens do not shorten make up a random string.

    Neighbours up to a plain word, a UUID, a digest or another part that tokens
    shorten are one string; a short part of the last kind is bridged where one
    side alone is too short to be looked at.
    """
    uuids = {m.start(): m.end() for m in UUID.finditer(text)}
    size = len(text.rstrip("="))
    groups: list[list[tuple[int, int]]] = []
    # bridged: parts since the last odd one that may be bridged; ended: nothing may join the last group
    bridged, ended, inside, last = 0, True, 0, 0
    for m in PART.finditer(text):
        a, b = m.span()
        inside = uuids.get(a, inside)
        ended, last = ended or a - last > GAP, b
        if a < inside or digest(m[0]):
            ended = True
        elif not short(m[0], ratio, ranks):
            bridged += 1
            ended = ended or bridged > 1 or b - a > GAP or bool(PLAIN.fullmatch(m[0]))
        else:
            part = (a, len(text) if b == size else b)
            least = min(groups[-1][-1][1] - groups[-1][0][0], b - a) if groups else 0
            if ended or (bridged and least >= LEAST_RANDOM):
                groups.append([part])
            else:
                groups[-1].append(part)
            bridged, ended = 0, False
    for group in groups:
        union = (group[0][0], group[-1][1])
        # what joins the parts may be too long a share of them
        for a, b in [union] if short(text[slice(*union)], ratio, ranks) else group:
            if b - a >= LEAST_RANDOM and not known_string(text[a:b], ratio, ranks):
                yield a, b


def random_spans(text: str, ratio: float = RATIO, ranks: str = RANKS) -> list[tuple[int, int, int]]:
    """Strings with few characters per token, but for digests and identifiers.

    A run with plain words, or one that tokens shorten as a whole, is looked
    at by its parts, so that words joined to a random string neither hide nor
    widen it; if no part is odd, the whole may be.
    """
    out = []
    for m in CANDIDATE.finditer(text):
        whole = m[0]
        if not PART.search(whole):
            continue
        odd = short(whole, ratio, ranks) and not known_string(whole, ratio, ranks)
        parts = [] if odd and not has_word(whole, ratio, ranks) else list(odd_parts(whole, ratio, ranks))
        out += [(m.start() + a, 3, m.start() + b) for a, b in parts or [(0, len(whole))] * odd]
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan_text(text: str, ratio: float = RATIO, ranks: str = RANKS) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    kinds = [kind for _, kind, _ in base]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + random_spans(text, ratio, ranks))


def scan_secrets(docs: DataFrame, ratio: float = RATIO, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and
    kind.  Null text counts as empty and has no span; repeated rows are scanned
    each; other columns are ignored; an empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(text or "", ratio, ranks) for text in batch.column(1).to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
