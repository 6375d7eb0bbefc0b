"""Secret scans: fixed patterns, and strings that a primed compressor finds new.

A candidate stands in a sensitive context: after a word like key, auth or
credential on its line, on the next line where that line ends by opening a value
(a colon, an equals sign, a bracket), or in the body of a private key. It looks
like one token: 16 or more of the value characters of the base patterns, cut at
``=`` and, where the whole is not novel, at ``.``, ``/`` and other marks; or a
quoted string without blanks that holds other marks as well. Of an address only
segments are candidates, those with marks inside only if they mix small letters,
capitals and digits, so host names and plain paths are left alone; the password
before an address's host is one in any context. A candidate's novelty is what it adds to the zstandard
size of the code around it, when the compressor has already seen a dictionary of
that code and of common identifiers, as a share of what its own characters add
in random order. So neither its length nor its alphabet counts: identifiers,
known words and repetitive literals cost less than their shuffled characters,
random strings as much, and these are reported as kind ``novel``, wherever the
same value stands again. Values of under 32 bits, like
runs of one character, and those whose pairs of letters read like words are not.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from math import log2

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import keyed_texts, query, rest_of, table, with_rest

# fixed values: the base patterns, in the order of the kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGN, MIN_ACCESS = 6, 20

# fixed values of the novelty rule
CONTEXT = re.compile(r"auth|bearer|cred|private|signature|key|pwd|pass|secret|token", re.IGNORECASE | re.ASCII)
LINE_END = re.compile(r"[\r\n]|\Z")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
PIECE = re.compile(r"[^=]+(?:=+\Z)?")
PARTS = tuple(re.compile(p) for p in (r"[^.]{16,}", r"[^/]{16,}", r"[^+_-]{16,}"))
LETTERS = re.compile(r"[A-Za-z]+")
MIN_VALUE, MARGIN = 16, 8
OPENS = tuple(":=({[\\")
NEXT_LINE = re.compile(r"\s*[^\r\n]*")
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----(?:[A-Za-z0-9+/=:,.\s\\]|-(?!-))*+(?=-----END|\Z)")
QUOTED = re.compile(r"""(["'`])([!#-&(-_a-~]{16,}+)\1""")
ADDRESS = re.compile(r"""://[^\s"'`<>]*+""")
LOGIN = re.compile(r"""://[^\s/:@"'`<>]*+:([^\s/@"'`<>]{16,}+)@""", re.ASCII)
SEGMENT = re.compile(r"[^/=]{16,}")
AROUND = 256
#: share of the size of its shuffled characters, number of shuffles, bits that the counts of its characters hold
MIN_SHARE, SHUFFLES, MIN_BITS = 0.85, 3, 32
LEVEL = 12
_WORDS = (
    "access account action address admin alias app application array async attribute auth authentication authorization base "
    "basic bearer body build cache callback change check class client cloud code column common config configuration connect "
    "connection console constant container content context control cookie credential current custom data database date "
    "debug default delete description document enable encode encoding endpoint environment error event example expire "
    "export false field file filter folder format function generate global handle handler hash header host identifier image "
    "import instance integer interface internal item job json local location message method model module name network node "
    "null number object option package param password path pattern payload permission placeholder plugin port prefix "
    "private process production profile project property protocol provider proxy public query queue random record redirect "
    "refresh register release remote request required reset resource response result return role root route sample schema "
    "scope script search secret secure server service session setting signature source state status storage store string "
    "success support system table target task template test text time title token transaction true type undefined update "
    "upload user username valid value variable version view your"
).split()
IDENTIFIERS = " ".join([*(w.title() for w in _WORDS), *_WORDS, "_".join(_WORDS[:40]), "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "])


def _letter_bits() -> dict[str, float]:
    """Bits of a letter after another in the words above, for each pair."""
    pairs = Counter(w[i : i + 2] for w in _WORDS for i in range(len(w) - 1))
    letters = "abcdefghijklmnopqrstuvwxyz"
    total = {x: sum(pairs[x + y] + 0.5 for y in letters) for x in letters}
    return {x + y: log2(total[x] / (pairs[x + y] + 0.5)) for x in letters for y in letters}


LETTER_BITS = _letter_bits()


def reads_like_words(value: str) -> bool:
    """Whether the pairs of ASCII letters are likelier in words than in random letters, with at most a digit in eight.

    By more than ``MARGIN`` bits, so of random values at most one in 2 ** MARGIN
    passes for words; letters of one case alone, as in prose, need no margin.
    """
    if 8 * sum(c.isdigit() for c in value) > len(value):
        return False
    prose = value.isalpha() and (value.islower() or value.isupper() or value.istitle())
    bits = [LETTER_BITS[w[i : i + 2]] for w in LETTERS.findall(value.lower()) for i in range(len(w) - 1)]
    return sum(bits) - log2(26) * len(bits) < (0 if prose else -MARGIN)


def novelty(text: str, start: int, end: int) -> float:
    """Compressed bytes that a candidate adds to its context, as a share of what its characters add in random order."""
    value, n = text[start:end], end - start
    # the same value nearby, also where the edge cuts it, would make itself known
    before = text[max(0, start - AROUND - n) : start].replace(value, "\x20" * n)[-AROUND:]
    after = text[end : end + AROUND + n].replace(value, "\x20" * n)[:AROUND]
    candidate = value.encode()
    if sum(c * log2(n / c) for c in Counter(candidate).values()) < MIN_BITS:
        return 0.0
    known = (IDENTIFIERS + before + "\n" + after).encode("utf-8", "replace")
    lead = before[-16:].encode("utf-8", "replace")
    primed = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
    alone = len(coder.compress(lead))
    symbols, order = np.frombuffer(candidate, np.uint8), np.random.RandomState(n % 2**32)
    shuffled = [len(coder.compress(lead + order.permutation(symbols).tobytes())) - alone for _ in range(SHUFFLES)]
    return (len(coder.compress(lead + candidate)) - alone) * SHUFFLES / max(1, sum(shuffled))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind number and end of every match of the base patterns, by start and kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _is_novel(text: str, a: int, b: int) -> bool:
    return b - a >= MIN_VALUE and not reads_like_words(text[a:b]) and novelty(text, a, b) >= MIN_SHARE


def _novel_parts(text: str, a: int, b: int, least: int, depth: int = 0) -> list[tuple[int, int]]:
    """A piece from ``least`` on if it is novel, else its novel parts."""
    if a >= least and _is_novel(text, a, b):
        return [(a, b)]
    for at in range(depth, len(PARTS)):
        parts = [m.span() for m in PARTS[at].finditer(text, a, b)]
        if parts != [(a, b)]:
            return [s for x, y in parts if y - least >= MIN_VALUE for s in _novel_parts(text, x, y, least, at + 1)]
    return []


def _novel_in_run(text: str, a: int, b: int, least: int) -> list[tuple[int, int]]:
    """Novel values of a run of value characters without outer dots: what stands between ``=``, else all from ``least`` on."""
    b = a + len(text[a:b].rstrip("."))
    a = b - len(text[a:b].lstrip("."))
    pieces = [(a + m.start(), a + m.end()) for m in PIECE.finditer(text[a:b])]
    found = [s for x, y in pieces if y - least >= MIN_VALUE for s in _novel_parts(text, x, y, least)]
    late = [x for x, _ in pieces if x >= least]
    if not found and len(pieces) > 1 and late and _is_novel(text, late[0], b):
        found = [(late[0], b)]
    return found


def _novel_in_address(text: str, a: int, b: int, least: int) -> list[tuple[int, int]]:
    """Novel segments of a run inside an address."""
    found = []
    for m in SEGMENT.finditer(text, a, b):
        x, y = m.span()
        value = text[x:y]
        mixed = any(map(str.islower, value)) and any(map(str.isupper, value)) and any(map(str.isdigit, value))
        if x >= least and (value.isalnum() or mixed) and _is_novel(text, x, y):
            found.append((x, y))
    return found


def _context_end(text: str, start: int, least: int) -> int:
    """Where the sensitive context of a line ends: with it, the line after it, or the key whose head it is."""
    end = LINE_END.search(text, least).start()
    if (head := text.find("-----BEGIN ", start, end)) >= 0 and (key := PEM.match(text, head)):
        return max(end, key.end())
    tail = text[max(least, end - 64) : end].rstrip("\x20\t\"'`>|+-")
    return NEXT_LINE.match(text, end).end() if tail.endswith(OPENS) else end


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The stretches that spans cover, apart from each other, in order."""
    out: list[tuple[int, int]] = []
    for a, _, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _uncovered(covered: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """What covered stretches leave of one."""
    out, at = [], max(0, bisect_left(covered, (a,)) - 1)
    while at < len(covered) and covered[at][0] < b:
        if covered[at][0] > a:
            out.append((a, covered[at][0]))
        a = max(a, covered[at][1])
        at += 1
    return out + [(a, b)] * (a < b)


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Incompressible strings in sensitive contexts, or what base spans leave of them."""
    out = _spans_of_contexts(text, sorted(base))
    if "://" in text:
        covered = _merged(base + out)
        whole = [m.span(1) for m in LOGIN.finditer(text)]
        out += [(x, 3, y) for a, b in whole if (left := _uncovered(covered, a, b)) and _is_novel(text, a, b) for x, y in left]
    return sorted(out)


def _spans_of_contexts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out, line, i = [], 0, 0
    covered = _merged(base)
    while m := CONTEXT.search(text, line):
        least = m.end()
        start = max(text.rfind("\n", line, least), text.rfind("\r", line, least), line - 1) + 1
        end = _context_end(text, start, least)
        quoted = [m.span(2) for m in QUOTED.finditer(text, least, end) if not RUN.fullmatch(m[2]) and "://" not in m[2]]
        quoted = [(a, b) for a, b in quoted if _is_novel(text, a, b)]
        out += [(x, 3, y) for a, b in quoted for x, y in _uncovered(covered, a, b)]
        addresses = [m.span() for m in ADDRESS.finditer(text, start, end)]
        q = n = 0
        for run in RUN.finditer(text, start, end):
            a, stop = run.span()
            while q < len(quoted) and quoted[q][1] <= a:
                q += 1
            while n < len(addresses) and addresses[n][1] <= a:
                n += 1
            if q < len(quoted) and quoted[q][0] <= a:
                continue
            novel = _novel_in_address if n < len(addresses) and addresses[n][0] <= a else _novel_in_run
            while i < len(base) and base[i][2] <= a:
                i += 1
            j = i
            while a < stop:  # what base spans leave of the run
                while j < len(base) and base[j][2] <= a:
                    j += 1
                b = min(stop, max(a, base[j][0])) if j < len(base) else stop
                if b - least >= MIN_VALUE and b - a >= MIN_VALUE:
                    out += [(x, 3, y) for x, y in novel(text, a, b, least)]
                a = max(b, base[j][2]) if j < len(base) and base[j][0] < stop else stop
        line = end
    return out


def name(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mask: str = "[secret]") -> str:
    """The text with every span, or run of overlapping ones, replaced."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False, rest: Sequence[str] = ()) -> DataFrame:
    """Secrets of every whole text: counts by kind, all spans, and on request the text without them.

    Positions are code points, ends exclusive. Null and empty texts have no
    spans; a null text stays null when redacted. Equal rows give equal rows; a
    null key stays null. Other columns are not read, but for those in ``rest``,
    which come back as a struct of that name. One scan without a shuffle.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_spans string, spans string, redacted string"

    def run(batches):
        for rows in batches:
            out = []
            for doc, t in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                base = base_spans(t) if t else []
                every = sorted(base + novel_spans(t, base)) if t else []
                n = [sum(s[1] == k for s in every) for k in range(4)]
                out.append((doc, *n, name(base), name(every), (redact(t, every) if t else t) if with_text else None))
            columns = zip(*out, strict=True) if out else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *rest_of(rows)], kind.names)

    chosen = keyed_texts(docs, key, text, rest)
    kind = with_rest(schema, chosen)
    return chosen.mapInArrow(run, kind)


@query("op9_secret_novelty")
def op9(spark, folder):
    out = scan(table(spark, folder, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "n_novel", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
