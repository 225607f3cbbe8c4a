"""Secret scans: fixed patterns, and novelty against a primed compressor.

The base finds three kinds by pattern. The method adds spans of the kind ``novel``: a candidate is a long
unbroken string that stands in a sensitive context (a word of credentials shortly before it) and isn't already inside a base
span. A zstandard compressor is primed with a dictionary: code lengths of ordinary words and joined identifiers, the words of
code in general, and what surrounds the candidate. Only the candidate is compressed, and what an empty frame takes is
taken off; those bytes, over the bytes that random characters of the candidate's own alphabet carry, are its
novelty. Ordinary words, paths and what stands around cost few bytes; a random key can't be compressed, whatever its alphabet.

Spans are code points, end exclusive. Results for special rows: a NULL text is empty and has no spans; a
NULL id is an id; repeated rows are rows of their own; an empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import common

KINDS = ("assign", "access", "hex", "novel")
# The three patterns and least lengths are fixed values; ``a`` keeps letters beyond ASCII from folding to s or k.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CONTEXT = re.compile(
    r"(?ai:password|passwd|passphrase|secret|token|api.?key|access.?key|private.?key|credential|auth|bearer|"
    r"signature|webhook|client.?id)")
#: code points before a candidate in which a word of credentials makes the context sensitive
NEAR = 48
#: code points on either side that prime the compressor
AROUND = 2048
#: least novelty of a long candidate; joined words have mostly 0.7 to 1.1
NOVELTY = 0.95
#: share of what whole bytes have above the alphabet's bits that is asked of short candidates on top: too short for a table of
#: their own codes, random characters cost nearly whole bytes
SHORT = 0.6
#: characters up to which a candidate is short; the addition falls as 1 / length beyond
SHORT_CHARS = 48
#: identifiers that code uses everywhere
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key client_id client_secret authorization bearer "
    "username localhost example default config settings environment connection string public private static "
    "return function import export const require module version license copyright http https www com org html "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef xxxxxxxxxxxxxxxx "
    "0000000000000000 AAAAAAAAAAAAAAAA ---------------- ================ ________________")
#: words that identifiers are joined from
WORDS = (
    "access account action active admin agent alert analytics api app application archive asset audit auth aws "
    "azure backend backup base batch binding block bool branch browser bucket build button cache call campaign "
    "cert check class client cloud cluster code collection column command common component config connection "
    "consumer container content context control cookie core count create cron current custom customer dashboard "
    "data database date debug default delete deploy detail dev device dictionary direct disk display docker "
    "document domain download driver element email enable endpoint engine entity error event example executor "
    "export external factory feature field file filter firebase flag folder form format frame function gateway "
    "generator get global google group handler hash header health helper home host image import index info input "
    "instance integration interface internal invoice item java job key lambda layer library license limit link "
    "list listener load local lock log login main manager map master message meta method metric mobile mode model "
    "module monitor name namespace network node notification number object option order output owner package page "
    "param parent parser partition password path payment permission pipeline platform plugin policy pool port "
    "primary private process producer product production profile project property provider proxy public publisher "
    "query queue random read record redis refresh region register release remote render replica report repository "
    "request resource response result role root route rule runner runtime sample schedule schema scope script "
    "search secondary secret section security select sender server service session setting shared signature "
    "simple site source spark stage staging start state static status storage store stream string style submit "
    "support sync system table tag target task team template temp test text theme thread time timeout title token "
    "tool topic trace transaction type unit update upload url user util validation value variable vendor version "
    "view volume web webhook website widget window worker workflow workspace write zone the and for with that "
    "this from have not are was were been will would their there which about other into more some time only over "
    "after also")
_CLASSES = tuple((re.compile(p), n) for p, n in (("[0-9]", 10), ("[a-f]", 6), ("[g-z]", 20), ("[A-F]", 6), ("[G-Z]", 20)))
# A low strategy takes the dictionary's code lengths for short texts too; higher ones leave these uncoded.
_PACK = zstandard.ZstdCompressionParameters(
    window_log=17, chain_log=14, hash_log=14, search_log=4, min_match=4, target_length=32,
    strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0, write_checksum=0)


def _class_runs(data: np.ndarray, offsets: np.ndarray, members: bytes, least: int) -> np.ndarray:
    """Of every text, whether it has a run of at least so many bytes of a class."""
    inside = np.zeros(256, bool)
    inside[np.frombuffer(members, np.uint8)] = True
    begins, ends = common.runs(inside[data], offsets)
    long = begins[ends - begins >= least]
    found = np.zeros(len(offsets) - 1, bool)
    found[np.searchsorted(offsets, long, side="right") - 1] = True
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, place of the kind in KINDS, end; by start, then kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(spans)


@functools.cache
def _codes() -> bytes:
    """Head of a zstandard dictionary: code lengths trained on joined words, up to where the dictionary's content begins."""
    dice, words = random.Random(1), WORDS.split()
    every = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    samples = []
    for _ in range(400):
        few = dice.sample(words, 8)
        number = "".join(dice.choices("0123456789", k=dice.randint(1, 4)))
        samples.append((dice.choice("__--/. ").join(few[:4]) + dice.choice(" _-") + number + " "
                        + "".join(w.title() for w in few[4:7]) + f" {few[7]}\n" + dice.choice(every)).encode())
    trained = zstandard.train_dictionary(4096, samples, k=64, d=8, dict_id=1, level=3).as_bytes()
    # the head ends with three offsets
    return trained[:trained.index(struct.pack("<III", 1, 4, 8)) + 12]


def alphabet_bits(candidate: str) -> float:
    """Bits a random character of the candidate's alphabet carries: digits, a-f, g-z, A-F, G-Z and single signs, as it has them.

    A letter beyond f means all letters of its case.
    """
    has = [bool(p.search(candidate)) for p, _ in _CLASSES]
    has[1], has[3] = has[1] or has[2], has[3] or has[4]
    signs = len(set(re.findall(r"[^A-Za-z0-9]", candidate)))
    return math.log2(max(2, sum(n for (_, n), h in zip(_CLASSES, has, strict=True) if h) + signs))


def novelty(candidate: str, around: str) -> float:
    """Bytes that the candidate takes after its surroundings, over those of random characters of its alphabet.

    The surroundings are the dictionary, so they cost the same with any candidate. Capitals alone
    are compared as small letters: words are words in either case.
    """
    bits = alphabet_bits(candidate)
    if not re.search(r"[a-z]", candidate):
        candidate, around = candidate.lower(), around.lower()
    known = f"{WORDS} {IDENTIFIERS}\n{around}\n".encode("utf-8", "replace")
    primed = zstandard.ZstdCompressionDict(_codes() + known, dict_type=zstandard.DICT_TYPE_FULLDICT)
    pack = zstandard.ZstdCompressor(compression_params=_PACK, dict_data=primed)
    return 8 * (len(pack.compress(candidate.encode())) - len(pack.compress(b""))) / (bits * len(candidate))


def is_novel(candidate: str, around: str) -> bool:
    more = SHORT * (8 / alphabet_bits(candidate) - 1) * min(1.0, SHORT_CHARS / len(candidate))
    return novelty(candidate, around) >= NOVELTY + more


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out, at, upto = [], 0, 0
    for found in CANDIDATE.finditer(text):
        begin, end = found.span()
        # both lists rise: the furthest end of all base spans that begin before this one's
        while at < len(base) and base[at][0] < end:
            upto = max(upto, base[at][2])
            at += 1
        if begin < upto:
            continue
        word = found[0]
        if not (re.search(r"[0-9]", word) and re.search(r"[A-Za-z]", word)):
            continue
        if not CONTEXT.search(text, max(0, begin - NEAR), begin):
            continue
        around = text[max(0, begin - AROUND):begin] + " " + text[end:end + AROUND]
        if is_novel(word, around):
            out.append((begin, 3, end))
    return out


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                     ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])
# A text without one of these, and without a long run, has no span of any kind.
_KEYWORD = re.compile(rb"(?i:passw|secret|token|api_?key)")
_RUN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in common.pieces(batch, "text"):
            data, offsets = common.text_bytes(piece.column(1))
            long = _class_runs(data, offsets, _RUN, 20) | _class_runs(data, offsets, b"0123456789abcdef", 24)
            rows = []
            for i in range(piece.num_rows):
                raw = data[offsets[i]:offsets[i + 1]].tobytes()
                if long[i] or _KEYWORD.search(raw):
                    text = raw.decode()
                    base = base_spans(text)
                    spans = sorted(base + novel_spans(text, base)) if long[i] else base
                else:
                    base = spans = []
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(_told(base).encode()).hexdigest(), _told(spans)))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), *(pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(_SCHEMA)[1:]))],
                schema=_SCHEMA)


def scan(docs: DataFrame) -> DataFrame:
    """A row for each row: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, joined)."""
    common.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
