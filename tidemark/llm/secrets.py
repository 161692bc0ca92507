"""Secrets in texts, also below layers of encoding.

A worklist starts with the text itself. Each layer is scanned, and whatever in it
decodes (percent escapes, Unicode escapes, base64, and compressed data inside
base64) joins the list as a layer of its own, until no new layer comes up. Layers
that were seen at the same place before are left out, so cycles end. Spans found in
a layer are mapped to the characters of the text that it came from.
"""

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, groupby

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType

from tidemark.llm.arrow import fields, map_texts

# The kinds of secrets in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\[uUx]([0-9A-Fa-f]+?)(?=\\|$)")
BASE64 = (
    re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}"),
    re.compile(r"[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9_-]{16,}={0,2}"),
    re.compile(r"[A-Za-z0-9_-]{16,}={0,2}"),
)
# Lines of base64, the first of which may begin within a line and the last may end in one.
WRAPPED = re.compile(
    r"(?:[A-Za-z0-9+/_-]{16,}|[A-Za-z0-9+/_-]+\r?\n[\x20\t]*[A-Za-z0-9+/_-]{16,})"
    r"(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)*(?:(?:\r?\n[\x20\t]*)?={1,2})?"
)
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
BREAKS = re.compile(r"\s+")

# Bytes that are decompressed at a time. Longer content is scanned in parts of about this
# size, cut where no pattern can go on; a part without such a place grows to ``LONGEST``
# characters, and shares ``OVERLAP`` with the next one.
CHUNK = 2**21
# Bytes that go into a decompressor at once, and come out of one that can be limited; the
# memory that one may take.
STEP = 4
PIECE = 16
# First bytes by which compressed content is told from other.
HEAD = 256
MOST_MEMORY = 2**27
# Bytes that hold text: a stretch of printable ASCII, as long as the shortest pattern, in
# UTF-8 and codings like it or in UTF-16.
NARROW = re.compile(rb"[\t\n\r\x20-\x7e]{12}")
WIDE = (
    ("utf-16-le", re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12}")),
    ("utf-16-be", re.compile(rb"(?:\x00[\t\n\r\x20-\x7e]){12}")),
)
LONGEST = 2**26
OVERLAP = 2**16
# A character of no pattern, or a space between words: nothing above spans these.
APART = re.compile(r"[^A-Za-z0-9+/_=.%\\\"':\s-]|(?<=[A-Za-z0-9])\x20(?=[A-Za-z0-9])")

Span = tuple[int, int, int]


def scan(text: str) -> list[Span]:
    """Spans (kind, start, end) of the patterns in one layer, leftmost and not overlapping."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(2, *m.span()) for m in HEX.finditer(text)]
    return found


@dataclass(frozen=True)
class Layer:
    """A text, and the span of the document from which a span of it was decoded.

    With ``whole`` that is the same for all spans. ``shifted`` tells layers that come up only
    if first characters of a run are left out.
    """

    text: str
    place: Callable[[int, int], tuple[int, int]]
    whole: bool = False
    shifted: bool = False


class Source:
    """Bytes that come in pieces, as a file."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces = iter(pieces)
        self.held = b""

    def peek(self, size: int) -> bytes:
        """The next bytes, fewer only at the end."""
        parts, n = [self.held], len(self.held)
        while n < size and (piece := next(self.pieces, None)) is not None:
            parts.append(piece)
            n += len(piece)
        self.held = b"".join(parts)
        return self.held[:size]

    def read(self, size: int) -> bytes:
        found = self.peek(size)
        self.held = self.held[len(found) :]
        return found


def opener(head: bytes) -> Callable[[], object] | None:
    """What makes the decompressor for bytes that begin so; None if they are not compressed."""
    if head[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31)
    if head[:1] == b"\x78" and int.from_bytes(head[:2], "big") % 31 == 0:
        # Text may begin so as well: the header is two bytes.
        return zlib.decompressobj if begins(head, zlib.decompressobj()) else None
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if head[:6] == b"\xfd7zXZ\x00":
        return lambda: lzma.LZMADecompressor(memlimit=MOST_MEMORY)
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return lambda: zstandard.ZstdDecompressor(max_window_size=MOST_MEMORY).decompressobj()
    return None


def member(source: Source, tool: object) -> Iterator[bytes]:
    """The content of one member, in small pieces; the source is left behind it.

    A few bytes go in at a time, no more than a checksum has: all content has come out by
    the time that an error, in it or in the checksum behind it, is raised.
    """
    limited = not hasattr(tool, "flush")
    while not tool.eof and (given := source.read(STEP)):
        if not limited:
            yield tool.decompress(given)
            continue
        found = tool.decompress(given, PIECE)
        while found:
            yield found
            if tool.eof or tool.needs_input:
                break
            found = tool.decompress(b"", PIECE)
    source.held = tool.unused_data + source.held


def begins(head: bytes, tool: object) -> bool:
    """Whether content comes out of the first bytes of a member."""
    try:
        return any(member(Source([head]), tool))
    except BROKEN:
        return False


def inflate(source: Source) -> Iterator[bytes]:
    """The content of all members of compressed bytes, one after another.

    Input that ends early or is broken gives what there is up to that place. What follows
    the last member is left out.
    """
    while (make := opener(source.peek(HEAD))) is not None:
        try:
            yield from member(source, make())
        except BROKEN:
            return


BROKEN = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)


def plain_bytes(data: bytes) -> Iterator[bytes]:
    """The content of bytes that may be compressed several times over, in pieces."""
    source = Source([data])
    seen = set()
    while opener(source.peek(HEAD)) is not None:
        inner = Source(inflate(source))
        head = hashlib.sha256(inner.peek(CHUNK)).digest()
        # Content that is its own content again has no text.
        if head in seen:
            return
        seen.add(head)
        source = inner
    while piece := source.read(CHUNK):
        yield piece


def coding(head: bytes) -> tuple[str, int]:
    """The coding of text that begins so, and the bytes before it. Bytes that are not UTF-8,
    such as Latin-1, and control characters do not keep the rest from being read."""
    for name, pattern in WIDE:
        if found := pattern.search(head):
            return name, found.start() % 2
    return "utf-8", 0


def decoded(pieces: Iterable[bytes]) -> Iterator[str]:
    """The text of bytes that come in pieces, in pieces."""
    source = Source(pieces)
    name, skip = coding(source.peek(CHUNK))
    source.read(skip)
    decoder = codecs.getincrementaldecoder(name)("replace")
    while piece := source.read(CHUNK):
        yield decoder.decode(piece)
    yield decoder.decode(b"", final=True)


def in_parts(pieces: Iterable[str]) -> Iterator[str]:
    """A text in parts of about ``CHUNK`` characters, cut where no pattern goes on."""
    held, known = "", 0
    for piece in pieces:
        held += piece
        if len(held) <= CHUNK:
            continue
        if place := last_apart(held, known):
            yield held[:place]
            held = held[place:]
        elif len(held) > LONGEST:
            yield held
            held = held[-OVERLAP:]
        # What is left has no such place, but at its end.
        known = max(0, len(held) - 1)
    if held:
        yield held


def last_apart(text: str, start: int) -> int:
    """Where the last place after ``start`` ends at which a text can be cut; 0 if there is none."""
    size = 256
    while True:
        begin = max(start, len(text) - size)
        if places := [m.end() for m in APART.finditer(text, begin)]:
            return places[-1]
        if begin == start:
            return 0
        size *= 4


def unpack(data: bytes) -> Iterator[str]:
    """The text in bytes that may be compressed several times over, in parts, if any.

    Bytes count as text as they are if a stretch of them could match a pattern.
    """
    if opener(data[:HEAD]):
        yield from in_parts(decoded(plain_bytes(data)))
    if any(p.search(data) for p in (NARROW, *(pattern for _, pattern in WIDE))):
        yield from in_parts(decoded([data]))


def decode_base64(run: str) -> Iterator[tuple[str, bool]]:
    """The texts of a run of base64 from each of four characters on, and if not the first.

    What stands before a run may be of its alphabet, or a character may be one too many;
    without one of the others no byte is lost, and in step only one of the four is text.
    """
    plain = run.rstrip("=").replace("-", "+").replace("_", "/")
    for start in range(min(4, len(plain))):
        part = plain[start:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        yield from ((text, start > 0) for text in unpack(data))


def percent_bytes(run: str) -> bytes:
    return bytes.fromhex(run.replace("%", ""))


def decode_percent(run: str) -> str | None:
    """The text of a run, as Latin-1 if it is not UTF-8; compressed text if it is one part."""
    data = percent_bytes(run)
    if opener(data[:HEAD]):
        parts = unpack(data)
        first = next(parts, None)
        return first if next(parts, None) is None else None
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1")


def decode_escapes(run: str) -> str | None:
    codes = [int(c, 16) for c in ESCAPE.findall(run)]
    if any(c > 0x10FFFF for c in codes):
        return None
    # Surrogate pairs join in UTF-16; halves that stand alone stay as they are.
    return "".join(map(chr, codes)).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def rewritten(layer: Layer, pattern: re.Pattern, decode: Callable[[str], str | None]) -> Layer | None:
    """The layer with every run of the pattern decoded in place; None if none decodes."""
    parts: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    at = 0
    text = layer.text
    for match in pattern.finditer(text):
        decoded = decode(match[0])
        if decoded is None:
            continue
        begin, end = match.span()
        parts += text[at:begin], decoded
        if layer.whole:
            at = end
            continue
        starts += range(at, begin)
        ends += range(at + 1, begin + 1)
        # Characters that one escape each gave keep their place, others have the whole run.
        step, uneven = divmod(end - begin, len(decoded))
        if uneven or step < 3:
            starts += [begin] * len(decoded)
            ends += [end] * len(decoded)
        else:
            starts += range(begin, end, step)
            ends += range(begin + step, end + 1, step)
        at = end
    if not parts:
        return None
    parts.append(text[at:])
    if layer.whole:
        return Layer("".join(parts), layer.place, True, layer.shifted)
    starts += range(at, len(text))
    ends += range(at + 1, len(text) + 1)
    place = lambda s, e: layer.place(starts[s], ends[e - 1])
    return Layer("".join(parts), place, False, layer.shifted)


def base64_spans(text: str) -> set[tuple[int, int]]:
    """Where a text may hold base64: runs over both alphabets and over each, and lines of it.

    Lines of one width belong together, with the end of the line before them, the start
    of the line after them if that is shorter, both, or neither.
    """
    found = {m.span() for pattern in BASE64 for m in pattern.finditer(text)}
    if "\n" not in text:
        return found
    for match in WRAPPED.finditer(text):
        lines = [m.span() for m in LINE.finditer(text, *match.span())]
        if len(lines) < 2:
            continue
        found.add(match.span())
        sizes = [b - a for a, b in lines]
        ends = [*(b for _, b in lines[:-1]), match.end()]
        at = 0
        for size, group in groupby(sizes):
            after = at + len(list(group))
            shorter = after < len(sizes) and sizes[after] < size
            for first in {at, max(0, at - 1)}:
                for last in {after, after + shorter}:
                    if size >= 16 and last - first > 1:
                        found.add((lines[first][0], ends[last - 1]))
            at = after
    return found


def inner_layers(layer: Layer) -> Iterator[Layer]:
    """Everything that decodes in a layer, one step down."""
    text = layer.text
    found = []
    if "%" in text:
        found.append(rewritten(layer, PERCENT, decode_percent))
    if "\\" in text:
        found.append(rewritten(layer, ESCAPES, decode_escapes))
    yield from (x for x in found if x is not None)
    for start, end in base64_spans(text):
        span = layer.place(start, end)
        for part, shifted in decode_base64(BREAKS.sub("", text[start:end])):
            yield Layer(part, lambda s, e, span=span: span, True, layer.shifted or shifted)
    for match in PERCENT.finditer(text) if "%" in text else ():
        data = percent_bytes(match[0])
        if opener(data[:HEAD]):
            parts = unpack(data)
            span = layer.place(*match.span())
            first, second = next(parts, None), next(parts, None)
            if second is not None:
                yield from (
                    Layer(part, lambda s, e, span=span: span, True, layer.shifted)
                    for part in chain([first, second], parts)
                )


def find_secrets(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the text itself, and all spans with those below encodings."""
    base = scan(text)
    # What lies below encodings, by kind and the secret itself.
    below: dict[tuple[int, str], set[tuple[bool, int, int]]] = {}
    # Layers come one at a time, so of a long content one part is held for each depth.
    worklist = [inner_layers(Layer(text, lambda s, e: (s, e)))]
    seen = set()
    while worklist:
        inner = next(worklist[-1], None)
        if inner is None:
            worklist.pop()
            continue
        size = len(inner.text)
        key = (hashlib.sha256(inner.text.encode("utf-8", "surrogatepass")).digest(),)
        key += inner.place(0, size)
        if key not in seen:
            seen.add(key)
            for kind, start, end in scan(inner.text):
                found = below.setdefault((kind, inner.text[start:end]), set())
                found.add((inner.shifted, *inner.place(start, end)))
            worklist.append(inner_layers(inner))
    added = {(k, *span) for (k, _), spans in below.items() for span in apart(spans)}
    return base, list(added.union(base))


def apart(spans: Iterable[tuple[bool, int, int]]) -> list[tuple[int, int]]:
    """Of the places that give one secret, those that are meant.

    All runs that give it from their start; others, longest first, where none of these is.
    """
    ordered = sorted(spans, key=lambda s: (s[0], s[1] - s[2], s[1]))
    meant = [(start, end) for shifted, start, end in ordered if not shifted]
    taken: list[tuple[int, int]] = []
    for shifted, start, end in ordered:
        at = bisect(taken, (start, end))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
            taken.insert(at, (start, end))
            if shifted:
                meant.append((start, end))
    return meant


def listed(spans: list[Span]) -> str:
    """Spans as kind:start:end by start and kind, joined by commas."""
    ordered = sorted(spans, key=lambda x: (x[1], x[0], x[2]))
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in ordered)


SECRETS = fields(
    n_assign=LongType(),
    n_access=LongType(),
    n_hex=LongType(),
    base_spans=StringType(),
    spans=StringType(),
)


def secret_columns(text: str) -> tuple:
    base, found = find_secrets(text)
    counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
    return (*counts, listed(base), listed(found))


def scan_secrets(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row with counts and spans of the secrets in its text.

    Counts and ``base_spans`` are of the text as it is; ``spans`` adds what lies below
    encodings, at the characters that were decoded. Offsets are code points, the end
    exclusive. A null counts as empty; repeated rows stay; no shuffle.
    """
    return map_texts(docs, keep, SECRETS, lambda: secret_columns)
