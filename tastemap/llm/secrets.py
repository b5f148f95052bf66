r"""Operator 8, secret scans: fixed patterns plus a token-efficiency test.

Beside the three base kinds, every run of 16 or more characters ``[A-Za-z0-9+/_-]`` (with
up to two ``=`` after it) that holds a letter is encoded with a public byte-pair vocabulary.
Words and names take few tokens; a random string takes many, so a run with fewer than
``MAX_RATIO`` characters per token is reported as ``random``, with digits or without. Before
that, known digests (bare hex of a usual length), UUIDs, names (parts joined by ``_ - /``,
each a number of up to four digits, one token, or long for its tokens) and runs that lie
inside a base span are excluded, as are letters with fewer than ``MIN_DISTINCT`` different
ones (``mmmm...``). Base spans always stay. Digits alone are not reported: the ratio does
not tell a random number from any other.

Texts are searched as UTF-8 bytes (all patterns are ASCII, so matches are the same) and
spans are code points, end exclusive. Each row is handled alone: nothing is shuffled.

Edge cases: a null or empty text has no spans (``spans`` is empty and ``base_sha256`` the
digest of the empty string); repeated rows give a row each; an empty table an empty result.
``redact_secrets`` keeps all input columns, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tastemap.llm._common import read_table, rows, text_bytes

# The base patterns.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")  # maximal runs, as [0-9a-f]+ of 16 or more
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")

VOCABULARY = "byte_bpe_50k.tiktoken"
MAX_RATIO = 2.2
MIN_RUN = 16
MIN_DISTINCT = 5
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_RUN = re.compile(rb"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_RUN)
_UUID = re.compile(rb"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_BARE_HEX = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
_NAME = re.compile(rb"([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})([_/-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*")
_RUN_BYTES = np.zeros(256, bool)
_RUN_BYTES[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", np.uint8)] = True
MASK = "[SECRET]"


@functools.cache
def encoder(vocabulary: str):
    """The byte-pair encoder of a rank file: a name of the public set or a path."""
    import public_tokenizers
    import tiktoken
    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _tokens(run: bytes, vocabulary: str) -> int:
    return len(encoder(vocabulary).encode_ordinary(run.decode("ascii")))


def _is_name(bare: bytes, vocabulary: str) -> bool:
    bare = bare.strip(b"_/-")
    if not _NAME.fullmatch(bare):
        return False
    words = [p for p in re.split(rb"[_/-]+", bare) if not p.isdigit()]
    return all((n := _tokens(p, vocabulary)) == 1 or len(p) >= MAX_RATIO * n for p in words)


def _is_random(run: bytes, vocabulary: str) -> bool:
    bare = run.rstrip(b"=")
    if not re.search(rb"[A-Za-z]", bare) or not re.search(rb"[0-9]", bare) and len(set(bare)) < MIN_DISTINCT:
        return False
    if _UUID.fullmatch(bare) or len(bare) in DIGEST_LENGTHS and _BARE_HEX.fullmatch(bare):
        return False
    return len(run) < MAX_RATIO * _tokens(run, vocabulary) and not _is_name(bare, vocabulary)


def _run_windows(text: bytes) -> Iterator[tuple[int, int]]:
    """Byte ranges of runs of at least MIN_RUN run characters."""
    hit = np.zeros(len(text) + 2, np.int8)
    hit[1:-1] = _RUN_BYTES[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(hit))
    first, last = edge[::2], edge[1::2]
    long = last - first >= MIN_RUN
    yield from zip(first[long].tolist(), last[long].tolist())


def _random_parts(run: bytes, vocabulary: str, cuts: tuple[bytes, ...] = (b"/", b"_-")) -> Iterator[tuple[int, int]]:
    """Places of random strings in a run: the run itself, else its parts between slashes, else
    theirs between other joints (a key behind a long path dilutes the ratio of the whole)."""
    if len(run) < MIN_RUN:
        return
    if _is_random(run, vocabulary):
        yield 0, len(run)
    elif cuts:
        for part in re.finditer(rb"[^" + re.escape(cuts[0]) + rb"]+", run):
            yield from ((part.start() + a, part.start() + b) for a, b in _random_parts(part[0], vocabulary, cuts[1:]))


def find_spans(text: bytes, vocabulary: str = VOCABULARY) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in code points, by start, then kind, then end."""
    found = []
    if b":" in text or b"=" in text:  # every assignment holds one of them
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    base, reach, b = sorted((s, e) for s, _, e in found), 0, 0
    for lo, hi in _run_windows(text):
        digits = [(m.start(), 2, m.end()) for m in HEX.finditer(text, lo, hi)]
        found += digits
        while b < len(base) and base[b][0] <= lo:  # runs ascend: the furthest end of the spans before
            reach, b = max(reach, base[b][1]), b + 1
        # The whole run, not its pieces: a base span may cover only its start.
        whole = _RUN.match(text, lo)
        if reach < whole.end() and not any(s == lo and e >= whole.end() for s, _, e in digits):
            found += [(lo + s, 3, lo + e) for s, e in _random_parts(whole[0], vocabulary)]
    if found and not text.isascii():
        at = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        found = [(int(at[s]) - 1, k, int(at[e - 1])) for s, k, e in found]
    return sorted(found)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: counts per kind, digest of the base spans, all spans."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text in rows(batch, "id", "text"):
                spans = find_spans(text, vocabulary)
                count = [sum(k == kind for _, k, _ in spans) for kind in range(len(KINDS))]
                base = spans_text([x for x in spans if x[1] < len(BASE_KINDS)])
                out.append((key, *count, hashlib.sha256(base.encode()).hexdigest(), spans_text(spans)))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.string()] * 2)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    return text_bytes(docs).mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, "
                                             "n_random long, base_sha256 string, spans string")


def redact(text: str, vocabulary: str = VOCABULARY) -> str:
    """``text`` with every span replaced by MASK; overlapping spans become one."""
    out, at = [], 0
    for start, _, end in find_spans(text.encode(), vocabulary):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars",
                   vocabulary: str = VOCABULARY) -> DataFrame:
    """All documents with all their columns, secrets masked; ``length_col`` (if there) is
    the new length where a text changed. Null texts stay null."""
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            old = batch.column(at).to_pylist()
            new = [t if t is None else redact(t, vocabulary) for t in old]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            size = batch.schema.get_field_index(length_col)
            if size >= 0:
                sizes = [n if a == b else len(b) for n, a, b in zip(batch.column(size).to_pylist(), old, new)]
                batch = batch.set_column(size, batch.schema.field(size),
                                         pa.array(sizes, batch.schema.field(size).type))
            yield batch

    return docs.mapInArrow(mask, docs.schema)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))
