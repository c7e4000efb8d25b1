"""Secret scans: three fixed patterns, and zstandard novelty for what they miss.

The patterns give the base spans.  Novelty looks at every other long string without blanks
that mixes letters and digits, or cases as no name does, and has a sensitive word within
`AROUND` characters before or behind it, on whatever line, or as a part of its own name.
Strings that follow each other line by line, as a wrapped value does, are near what any of them
is near; all of a PEM block of a private key is near.  A UUID names something and is none.

A compressor is primed with common identifiers, with the names in the whole text and with the
text around the candidate, less its own repetitions, and the bytes that the candidate adds to
the compressed output are measured.  Names, words and repeated strings are found in the
dictionary and cost little; a string that costs `NOVEL` bytes a character or more is
incompressible, and is reported.  Random strings over small alphabets, and long ones, need
fewer bytes: a string that costs `LIKE_RANDOM` of what a random one of its alphabet and length
costs is reported as well.  What the patterns find is measured the same way; it is reported
whatever it costs, and its cost tells a real secret from a placeholder.

Offsets are code points, ends exclusive.  Defined cases: a null or empty text has no spans; a
null id is kept; repeated rows are scanned each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from string import ascii_letters, ascii_lowercase, ascii_uppercase, digits

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, texts

KINDS = ("assign", "access", "hex", "novel")
#: Characters on each side of a candidate that prime the compressor, and that are its context.
AROUND = 512
#: Compressed bytes a character from which a candidate counts as incompressible.
NOVEL = 0.85
#: The same as a part of what a random string over the candidate's own alphabet costs.
LIKE_RANDOM = 0.85
SHORTEST = 16
#: Characters of the primer that are compressed before and behind a string.
KNOWN = 96

# The base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HEX_DIGITS = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))

_SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase)|secret|token|api_?key|credential|private|bearer|signature|"
    r"access|auth|pwd",
    re.IGNORECASE | re.ASCII,
)
_HINTS = ("pass", "secret", "token", "key", "credential", "private", "bearer", "signature",
          "access", "auth", "pwd")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A whole run without '=', which parts names from values; what pads a run belongs to it.
_CANDIDATE = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?" % SHORTEST
)

_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: The words that names are made of.
_NAMES = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")
#: Neighbouring letters that are both of one case, as a part of a string's letters: names have
#: hardly any in upper case, or in lower case, random strings about a quarter of each.
BOTH_CASES = 0.08

#: Between the strings of a wrapped value: one line break at least, or the backslash of one.
_WRAP = re.compile(r"""["',;+\x20\t\r]*[\n\\][\s"'\\>#*|+]*""", re.ASCII)
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----.*?(?:-----END|\Z)", re.DOTALL)

#: Letters and digits of usual encodings, smaller sets first.
_ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "0123456789abcdefABCDEF",
    "234567" + ascii_lowercase,
    "234567" + ascii_uppercase,
    digits + ascii_lowercase,
    digits + ascii_uppercase,
    digits + ascii_letters,
)

_USUAL = (
    "import export public private static final class struct function return const string "
    "integer boolean config configuration settings environment variable default example "
    "placeholder changeme your_api_key_here insert_token_here xxxxxxxxxxxxxxxx username "
    "password client_id client_secret access_token refresh_token authorization Bearer Basic "
    "https://www.example.com/path/to/resource index.html application/json content-type "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 "
    "Account Action Address Array Async Attribute Base Block Buffer Build Builder Button Cache "
    "Callback Channel Check Client Code Collection Column Command Component Connection Content "
    "Context Controller Count Create Current Data Database Date Default Delete Device Document "
    "Element Encode Encoded Entity Entry Error Event Exception Executor Factory Field File Filter Find Flag Folder "
    "Form Format From Function Get Group Handle Handler Header Helper Host Image Index Info Input "
    "Instance Interface Item Iterator Job Key Language Length Level Link List Listener Loader Local "
    "Lock Logger Login Manager Map Matrix Memory Message Method Model Module Name Network Node "
    "Number Object Option Order Output Package Page Parameter Parse Parser Path Pattern Payment Pool "
    "Port Process Product Project Property Protocol Provider Proxy Query Queue Read Record Reference "
    "Register Remove Request Reset Resource Response Result Role Root Route Rule Scheduler Schema "
    "Select Send Server Service Session Set Setting Size Source Start State Status Storage Store "
    "Stream Table Target Task Template Test Text Thread Time Timeout Transaction Type Update Upload "
    "User Util Validate Validator Value Version View Widget With Worker Write "
)
#: Names begin with a capital or not.
IDENTIFIERS = _USUAL + " ".join(sorted({w.lower() for w in _USUAL.split() if w.istitle()})) + " "


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        found += [
            ("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6
        ]
    if "AKIA" in text:
        found += [
            ("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20
        ]
    if b"1" * 24 in text.encode("latin-1", "replace").translate(_HEX_DIGITS):
        found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def costs(strings: list[str], primer: str) -> list[int]:
    """Bytes that a compressor which knows the primer needs for each string."""
    known_bytes = primer.encode()
    primed = zstandard.ZstdCompressionDict(known_bytes, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    # a window and tables that reach back to the primer's first byte
    reach = max(16, (len(known_bytes) + 4 * max(map(len, strings))).bit_length())
    own = zstandard.ZstdCompressionParameters.from_level(
        19, window_log=reach, chain_log=reach, hash_log=reach, write_checksum=False,
        write_content_size=False, write_dict_id=False,
    )
    press = zstandard.ZstdCompressor(dict_data=primed, compression_params=own)
    # Between two known strings: a block's own bytes count for none of them, and the compressor
    # does not look for matches in a block's last bytes.
    before, behind = primer[-KNOWN:], primer[:KNOWN]
    sizes = [len(press.compress((before + s + behind).encode())) for s in ["", *strings]]
    return [size - sizes[0] for size in sizes[1:]]


def random_like(string: str) -> str:
    """A random string of the same length over the string's alphabet; always the same one."""
    used = set(string)
    plain = {c for c in used if c.isascii() and c.isalnum()}
    alphabet = next(a for a in _ALPHABETS if plain.issubset(a)) + "".join(sorted(used - plain))
    return "".join(random.Random(len(string)).choices(alphabet, k=len(string)))


def novelty(string: str, primer: str) -> tuple[int, bool]:
    """The string's marginal bytes, and whether it is about as incompressible as a random one."""
    bytes_, of_random = costs([string, random_like(string)], primer)
    return bytes_, bytes_ >= NOVEL * len(string) or bytes_ >= LIKE_RANDOM * of_random


class _Places:
    """Disjoint intervals in order."""

    def __init__(self, found: list[tuple[int, int]]) -> None:
        self.starts = [a for a, _ in found]
        self.ends = [b for _, b in found]

    def around(self, start: int, stop: int) -> bool:
        """Whether one of them holds all of start to stop."""
        k = bisect_right(self.starts, start) - 1
        return k >= 0 and stop <= self.ends[k]


def _united(found: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one."""
    runs: list[tuple[int, int]] = []
    for _, start, end in sorted(found, key=lambda s: s[1:]):
        if runs and start <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], end)
        else:
            runs.append((start, end))
    return runs


class _Context:
    """Where a text speaks of secrets."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.words = _Places([m.span() for m in _SENSITIVE.finditer(text)])
        self.pem = _Places([m.span() for m in _PEM.finditer(text)])

    def any(self, block: list[tuple[int, int]]) -> bool:
        """Whether a sensitive word is near a block of candidates.

        Letters of a candidate that happen to spell a word are none: it has to stand alone.
        """
        start, stop = block[0][0], block[-1][1]
        starts, ends = self.words.starts, self.words.ends
        first, behind = bisect_left(starts, start), bisect_left(starts, stop)
        return (
            (first > 0 and start - ends[first - 1] <= AROUND)
            or (behind < len(starts) and starts[behind] - stop <= AROUND)
            or self.pem.around(start, start)
            or any(self._alone(k) for k in range(first, behind))
        )

    def _alone(self, k: int) -> bool:
        a, b = self.words.starts[k], self.words.ends[k]
        return not self.text[max(0, a - 1) : a].isalnum() and not self.text[b : b + 1].isalnum()


def _wrapped(text: str) -> Iterator[list[tuple[int, int]]]:
    """The candidates of a text, those of one wrapped value together."""
    block: list[tuple[int, int]] = []
    for m in _CANDIDATE.finditer(text):
        if block and not _WRAP.fullmatch(text, block[-1][1], m.start()):
            yield block
            block = []
        block.append(m.span())
    if block:
        yield block


def _made_up(string: str) -> bool:
    """Whether letters and digits, or both cases, are mixed; words and numbers are none."""
    letters = sum(map(str.isalpha, string))
    if not letters or _UUID.fullmatch(string):
        return False
    if any(map(str.isdigit, string)):
        return True
    pairs = list(zip(string, string[1:]))
    least = BOTH_CASES * letters
    return (
        sum(a.isupper() and b.isupper() for a, b in pairs) >= least
        and sum(a.islower() and b.islower() for a, b in pairs) >= least
    )


class _Primers:
    """What a compressor knows of a text before it meets one of its strings."""

    def __init__(self, text: str, base: list[tuple[str, int, int]], identifiers: str) -> None:
        self.text, self.base, self.identifiers = text, base, identifiers
        self._names: str | None = None

    def names(self) -> str:
        """The words of the names in the whole text, strings that may be secrets left out."""
        if self._names is None:
            judged = [("", *m.span()) for m in _CANDIDATE.finditer(self.text) if _made_up(m[0])]
            rest, at = [], 0
            for start, end in _united(self.base + judged):
                rest.append(self.text[at:start])
                at = end
            rest.append(self.text[at:])
            found = {name for part in rest for name in _NAMES.findall(part)}
            self._names = " ".join([self.identifiers, *sorted(found)])
        return self._names

    def novelty(self, start: int, stop: int) -> tuple[int, bool]:
        string, text = self.text[start:stop], self.text
        around = text[max(0, start - AROUND) : start] + " " + text[stop : stop + AROUND]
        # a secret that stands there twice would otherwise make itself known
        return novelty(string, self.names() + " " + around.replace(string, " "))


def _measured_novel(
    text: str, base: list[tuple[str, int, int]], primers: _Primers
) -> Iterator[tuple[str, int, int, int, bool]]:
    low = text.lower()
    if not any(hint in low for hint in _HINTS):
        return
    near = _Context(text)
    covered = _Places(_united(base))
    for block in _wrapped(text):
        if not near.any(block):
            continue
        for start, stop in block:
            if not _made_up(text[start:stop]) or covered.around(start, stop):
                continue
            bytes_, incompressible = primers.novelty(start, stop)
            if incompressible:
                yield "novel", start, stop, bytes_, True


def novel_spans(
    text: str, base: list[tuple[str, int, int]], identifiers: str = IDENTIFIERS
) -> list[tuple[str, int, int]]:
    """Incompressible strings near sensitive words that no base span covers whole."""
    primers = _Primers(text, base, identifiers)
    return [found[:3] for found in _measured_novel(text, base, primers)]


def spans(text: str) -> list[tuple[str, int, int]]:
    base = base_spans(text)
    return base + novel_spans(text, base)


def measured(text: str, identifiers: str = IDENTIFIERS) -> list[tuple[str, int, int, int, bool]]:
    """All spans, the marginal bytes of each, and whether it is incompressible.

    Of an assignment the value is measured, of other spans all.
    """
    base = base_spans(text)
    primers = _Primers(text, base, identifiers)
    out = []
    for kind, start, stop in base:
        value = _ASSIGN.match(text, start).start(2) if kind == "assign" else start
        out.append((kind, start, stop, *primers.novelty(value, stop)))
    return out + list(_measured_novel(text, base, primers))


def listed(found: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then by kind."""
    found = sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


_FIELDS = ("kind", "start", "end", "bytes", "incompressible")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): kind, start, end and cost of everything found, a row for each row."""
    prepare(docs.sparkSession)
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    schema = pa.schema(
        [("doc_id", pa.int64()), ("spans", pa.list_(pa.struct(list(zip(_FIELDS, types)))))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(_FIELDS, s)) for s in measured(t)]
                for t in batch.column("text").to_pylist()
            ]
            yield batch_of(schema, doc_id=batch.column("doc_id"), spans=found)

    return texts(docs, id_col, text_col).mapInArrow(
        run,
        "doc_id long, spans array<struct<kind: string, start: long, end: long, bytes: long, "
        "incompressible: boolean>>",
    )


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, cost_bytes, n_incompressible).

    The last two are sums over all spans, of marginal bytes and of those that are incompressible.
    """

    def order(kinds: tuple[str, ...]):
        rank = "array_position(array({}), s.kind)".format(", ".join(f"'{k}'" for k in KINDS))
        own = ", ".join(f"'{k}'" for k in kinds)
        return F.expr(
            "array_join(transform(array_sort(transform(filter(spans, s -> s.kind in ("
            + own + ")), s -> named_struct('start', s.start, 'rank', " + rank
            + ", 'kind', s.kind, 'end', s.end))), s -> concat(s.kind, ':', s.start, ':', s.end))"
            ", ',')"
        )

    return found.select(
        "doc_id",
        *(
            F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}")
            for k in KINDS[:3]
        ),
        F.sha2(order(KINDS[:3]), 256).alias("base_sha256"),
        order(KINDS).alias("spans"),
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.bytes)").alias("cost_bytes"),
        F.expr("cast(size(filter(spans, s -> s.incompressible)) as long)").alias(
            "n_incompressible"
        ),
    )


def redacted(text: str) -> str:
    """The text with every span (overlapping ones as one) replaced by a mark."""
    out, at = [], 0
    for start, end in _united(spans(text)):
        out += [text[at:start], "[SECRET]"]
        at = end
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with secrets replaced in their texts; a null text stays null."""
    prepare(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t if t is None else redacted(t))

    clean.func.__annotations__ = {"text": pd.Series, "return": pd.Series}
    return docs.withColumn(text_col, clean(F.col(f"`{text_col}`")))


def base_sha256(text: str) -> str:
    return hashlib.sha256(listed(base_spans(text)).encode()).hexdigest()
