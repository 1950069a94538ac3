"""Secret scan with a worklist of decoded layers.

Each text is scanned as it is (the base spans).  Then it is unwrapped: percent escapes,
Unicode escapes and character references are decoded in place, and base64 stretches become layers of their own, which
may hold compressed data.  An escape whose decoded character begins another one is followed to its
innermost code at once (``%252541`` is ``A``), so a nest costs its length, however deep it is.  A layer decoded in place is the stretch around the escapes that a
match can run over, not the whole text: the rest holds what its parent held.  Base64 is decoded
line by line, as whole blocks over line ends and as stretches of equally long lines.  Decoded
bytes are read as UTF-8 with replacements, or as UTF-16 where a mark or their NULs say so;
text that still has NULs is read once more without them.  Every new layer is put on the worklist, scanned and unwrapped in
its turn until nothing new appears.  A layer is known by its content and its place in the
original, so a layer that decodes to itself or to an ancestor ends there.  Spans found in a
layer are mapped back to the stretch of the original text (code points) they come from.

Compressed layers (all members, one after the other) are read as a stream in windows that end
where no match can be running, so a text that unpacks to far more than itself doesn't fill the
memory.  A base64 run that is longer than a window is decoded as a stream in its turn.  Where
MOST_HELD characters give no place to end, the next window begins WINDOW characters earlier; what was seen below a
window is forgotten after it.  All layers are read, so the time of a document grows with what
it decodes to.  Only a caller that gives ``most_decoded`` ends a document after that many
decoded characters; such a document says so in ``n_unread`` (its base spans are never affected).

The work is per document, in Arrow batches without a shuffle.

Defined results: a null or empty text has no spans; repeated rows are scanned alike; an empty
table gives no rows; long texts are scanned whole; a null doc_id is carried through;
further columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import bz2
import codecs
import hashlib
import itertools
import lzma
import re
import zlib
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from clickflow.llm.common import id_text

# The patterns and least lengths of the contract.  ASCII letters only fold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same as runs of [0-9a-f]+ of which those of 32 or more count
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex")

ESCAPE_LEAD = re.compile(r"%(?=[0-9A-Fa-f]{2})|\\(?=[uxU])|&(?=\#)")
#: What follows the lead of an escape: hexadecimal digits, or decimal ones in the last group.
ESCAPE_BODY = {
    "%": re.compile(r"([0-9A-Fa-f]{2})()"),
    "\\": re.compile(r"(?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8})|u\{([0-9A-Fa-f]{1,6})\})()"),
    "&": re.compile(r"\#(?:[xX]([0-9A-Fa-f]{1,6})|([0-9]{1,7}));"),
}
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
BLOCK = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
LINE_END = re.compile(r"\r?\n[\x20\t]*")
OUTSIDE = re.compile(r"""[^A-Za-z0-9+/_.=\-"'\x20\t\r\n:%\\&\#;{}]""")  # no match, escape or block runs over these
MAGIC = (b"\x1f\x8b", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
CUT = re.compile(OUTSIDE.pattern + r"|(?<=[!-~]\x20)[A-Za-z]{1,40}\x20(?=[A-Za-z])")  # nor over a plain word's end
BLANKS = re.compile(r"\x20{65,}")
RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN_END = re.compile(r"[^A-Za-z0-9+/_-]")
OVERLAP = 64  # more than what shows a match in a run
WINDOW = 4 << 20
LONG_RUN = WINDOW // 2
MOST_HELD = 16 * WINDOW
PIECE = 1 << 20
FEED = 1 << 14


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every match, sorted."""
    found = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGN:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end()))
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m.end()))
    return sorted(found)


class Layer:
    """A decoded text and, for its stretches, where they come from in the original."""

    def __init__(self, text: str, at: list[int], source: list[tuple[int, int, bool]]):
        self.text, self.at, self.source = text, at, source  # at: starts; source: start, end, one to one

    def original(self, start: int, end: int) -> tuple[int, int]:
        i = bisect.bisect_right(self.at, start) - 1
        a, b, exact = self.source[i]
        first = a + start - self.at[i] if exact else a
        j = bisect.bisect_right(self.at, max(end - 1, start)) - 1
        a, b, exact = self.source[j]
        return first, a + end - self.at[j] if exact else b


def _one_escape(text: str, at: int) -> tuple[int, bool, int]:
    """The code that the escape at ``at`` comes to, whether it is a byte, and where it ends; code -1 if it is none.

    An escape that decodes to the lead of another one goes on with that: a nest of any depth and mixture is
    read once, from its outside to the innermost code."""
    lead, code, byte, end = text[at], -1, False, at
    while body := ESCAPE_BODY[lead].match(text, end + 1 if code < 0 else end):
        digits = next(g for g in body.groups() if g)
        decimal = lead == "&" and body[2]
        value = int(digits, 10 if decimal else 16)
        if value > 0x10FFFF:
            break
        code, byte, end = value, lead == "%", body.end()
        if chr(code) not in ESCAPE_BODY:
            break
        lead = chr(code)
    return code, byte, end


def _plain(codes: list[tuple[int, bool]]) -> str:
    """The text of decoded codes: bytes are UTF-8 (else Latin-1), pairs of surrogates one character."""
    out = []
    for byte, run in itertools.groupby(codes, key=lambda c: c[1]):
        values = [c for c, _ in run]
        if byte:
            try:
                out.append(bytes(values).decode())
            except UnicodeDecodeError:
                out.append(bytes(values).decode("latin-1"))
        else:
            out.append("".join(map(chr, values)).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace"))
    return "".join(out)


def escape_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and decoded text of every run of escapes."""
    at = 0
    while m := ESCAPE_LEAD.search(text, at):
        start = at = m.start()
        codes = []
        while at < len(text) and text[at] in ESCAPE_BODY:
            code, byte, end = _one_escape(text, at)
            if code < 0:
                break
            codes.append((code, byte))
            at = end
        if codes:
            yield start, at, _plain(codes)
        else:
            at += 1


def _stretch_start(text: str, at: int, least: int) -> int:
    """Where the stretch before ``at`` that a match can run over begins, at ``least`` or after."""
    step = 256
    while True:
        low = max(least, at - step)
        ends = [m.end() for m in OUTSIDE.finditer(text, low, at)]
        if ends or low == least:
            return ends[-1] if ends else least
        step *= 4


def decoded_in_place(layer: Layer) -> Iterator[Layer]:
    """For every stretch with escapes that a match can run over, a layer with the escapes decoded."""
    runs, text = escape_runs(layer.text), layer.text
    run, done = next(runs, None), 0
    while run is not None:
        done = _stretch_start(text, run[0], done)
        outside = OUTSIDE.search(text, run[1])
        stop = outside.start() if outside else len(text)
        parts, at, source, here, changed = [], [], [], 0, False

        def add(part: str, a: int, b: int, exact: bool) -> None:
            nonlocal here
            if part:
                parts.append(part)
                at.append(here)
                source.append((a, b, exact))
                here += len(part)

        def copied(a: int, b: int) -> None:  # unchanged text keeps its finer stretches
            i = bisect.bisect_right(layer.at, a) - 1
            while a < b:
                end = min(b, layer.at[i + 1] if i + 1 < len(layer.at) else b)
                o, e, exact = layer.source[i]
                add(text[a:end], o + a - layer.at[i] if exact else o, o + end - layer.at[i] if exact else e, exact)
                a, i = end, i + 1

        while run is not None and run[0] < stop:
            start, end, plain = run
            copied(done, start)
            add(plain, *layer.original(start, end), False)
            done, changed = end, True
            run = next(runs, None)
        copied(done, stop)
        done = stop
        if changed and parts:
            yield Layer("".join(parts), at, source)


def _with_head(pieces: Iterator[bytes], least: int) -> tuple[bytes, Iterator[bytes]]:
    """The first bytes of a stream, at least so many if it has them, and the whole stream."""
    head = b""
    while len(head) < least and (piece := next(pieces, None)) is not None:
        head += piece
    return head, itertools.chain([head], pieces)


def _machine(head: bytes):
    if head.startswith(b"\x28\xb5\x2f\xfd"):
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    if head.startswith(b"BZh"):
        return bz2.BZ2Decompressor()
    if head.startswith(b"\xfd7zXZ\x00"):
        return lzma.LZMADecompressor()
    return zlib.decompressobj(47)  # zlib or gzip by its head


def _member(head: bytes, pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Unpack one member piece by piece; returns the bytes read after it, None where it is damaged or cut off."""
    machine = _machine(head)
    zstd = head.startswith(b"\x28\xb5\x2f\xfd")
    feed = FEED >> 6 if zstd else FEED  # what zstd makes of its input can't be bounded
    try:
        for piece in pieces:
            for i in range(0, len(piece), feed):
                data = piece[i : i + feed]
                while True:
                    if out := machine.decompress(data) if zstd else machine.decompress(data, PIECE):
                        yield out
                    if machine.eof:
                        return machine.unused_data + piece[i + feed :]
                    data = getattr(machine, "unconsumed_tail", b"")
                    if zstd or not data and (len(out) < PIECE if hasattr(machine, "unconsumed_tail") else machine.needs_input):
                        break
    except (zlib.error, OSError, lzma.LZMAError, EOFError) as e:
        del e
    except Exception as e:  # zstandard's own error type, which is only known where it is installed
        if type(e).__name__ != "ZstdError":
            raise
    return None


def _unpack(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Unpack a stream, member after member; what follows the last one comes as it is."""
    head, rest = _with_head(pieces, 8)
    while head.startswith(MAGIC):
        after = yield from _member(head, rest)
        if after is None:
            return
        while len(after := after.lstrip(b"\x00")) < 8 and (piece := next(pieces, None)) is not None:  # padding
            after += piece
        head, rest = after, itertools.chain([after], pieces)
    if head:
        yield b"\n"
        yield from rest


def _base64(run: str) -> bytes:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:  # holds no further byte
        body = body[:-1]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and joined lines of base64 over line ends: each block, and its stretches of equally long lines."""
    for m in BLOCK.finditer(text):
        yield m.start(), m.end(), LINE_END.sub("", m[0])
        lines = [(x.start(), x.end()) for x in LINE.finditer(text, m.start(), m.end())]
        first = 0
        while first < len(lines):
            width, last = lines[first][1] - lines[first][0], first + 1
            while last < len(lines) and lines[last][1] - lines[last][0] == width:
                last += 1
            stop = last + 1 if last < len(lines) and lines[last][1] - lines[last][0] < width else last  # its last line
            if width >= 16 and stop - first > 1 and (first or stop < len(lines)):
                a, b = lines[first][0], lines[stop - 1][1]
                yield a, b, LINE_END.sub("", text[a:b])
            first = last


def _last_cut(text: str) -> int:
    """The last place of a text that no match runs over, 0 if there is none."""
    step = 1 << 10
    while True:
        low = max(0, len(text) - step)
        ends = [m.end() for m in CUT.finditer(text, low)]
        if ends or not low:
            return ends[-1] if ends else 0
        step *= 8


def _run_bytes(run: str, texts: Iterator[str], after: list[str], note: Callable[[str], None]) -> Iterator[bytes]:
    """Decode a base64 run that goes on in ``texts``; ``after`` gets the text behind it, ``note`` the run itself."""
    text, ahead, left = run, "", ""
    while text is not None:
        end = RUN_END.search(text)
        body = text[: end.start()] if end else text
        note(ahead + body)
        ahead = (ahead + body)[-OVERLAP:]
        left += body
        whole = len(left) // 4 * 4
        if whole:
            yield _base64(left[:whole])
            left = left[whole:]
        if end:
            after.append(ahead + text[end.start() :])
            break
        text = next(texts, None)
    else:
        after.append(ahead)
    if len(left) > 1:
        yield _base64(left)


def _block_bytes(text: str, texts: Iterator[str], after: list[str], note: Callable[[str], None]) -> Iterator[bytes]:
    """The same for a block of equally long lines and a shorter last one; ``note`` gets the lines."""
    width, left = text.index("\n"), ""
    lines = re.compile(r"(?:[A-Za-z0-9+/_-]{%d}\n)*" % width)
    while True:
        end = lines.match(text).end()
        if end:
            note(text[:end])
            left += text[:end].replace("\n", "")
            whole = len(left) // 4 * 4
            yield _base64(left[:whole])
            text, left = text[end:], left[whole:]
        if len(text) > width or (more := next(texts, None)) is None:
            break
        text += more
    after.append(text)
    last = LINE.match(text)
    if last and last.end() <= width:
        left += last[0]
    if len(left) > 1:
        yield _base64(left)


def _encoding(head: bytes) -> str:
    if head.startswith((b"\xff\xfe", b"\xfe\xff")):
        return "utf-16"
    half = len(head) // 2
    even, odd = head[: 2 * half : 2].count(0), head[1::2].count(0)
    if 2 * max(even, odd) > half > 8 * min(even, odd):
        return "utf-16-le" if odd > even else "utf-16-be"
    return "utf-8"


def _texts(pieces: Iterator[bytes]) -> Iterator[str]:
    """The pieces as text whose line ends are single characters without blanks after them."""
    head, pieces = _with_head(pieces, FEED)
    decoder = codecs.getincrementaldecoder(_encoding(head[:FEED]))("replace")
    held = ""
    for piece in itertools.chain(pieces, [None]):
        text = held + (decoder.decode(b"", True) if piece is None else decoder.decode(piece))
        end = len(text) if piece is None else len(text.rstrip("\x20\t\r\n"))
        if len(text) - end > FEED:
            end = len(text)
        held = text[end:]
        yield LINE_END.sub("\n", text[:end])


def _long_run(text: str) -> tuple[int, bool]:
    """Where the base64 at the end of a text begins if it is long, and whether it has line ends."""
    start = len(text.rstrip(RUN))
    if len(text) - start >= LONG_RUN:
        return start, False
    start = len(text.rstrip(RUN + "\n"))
    lines = text[start:].split("\n")
    first = len(lines) - 1
    while first > 0 and len(lines[first - 1]) == len(lines[-2]) >= 16:
        first -= 1
    start += sum(len(x) + 1 for x in lines[:first])
    return (start, True) if first < len(lines) - 1 and len(text) - start >= LONG_RUN else (len(text), False)


def _windows(pieces: Iterator[bytes], note: Callable[[str], None]) -> Iterator[str | Iterator[bytes]]:
    """A text in windows, and the decoded bytes of each base64 run that is too long for them."""
    texts = _texts(pieces)
    held, size, due = [], 0, WINDOW
    for text in texts:
        held.append(text)
        size += len(text)
        if size < due:
            continue
        text = BLANKS.sub(" " * OVERLAP, "".join(held))  # the places in a window don't matter
        if cut := _last_cut(text):
            yield text[:cut]
            text = text[cut:]
        start, lines = _long_run(text)
        if start < len(text):
            if start:
                yield text[:start] if lines else text[: start + OVERLAP]
            after: list[str] = []
            run = (_block_bytes if lines else _run_bytes)(text[start:], texts, after, note)
            yield run
            for _ in run:
                pass
            text = "".join(after)
        elif len(text) >= MOST_HELD:
            yield text
            text = text[-WINDOW:]
        held, size = [text], len(text)
        due = WINDOW if size < WINDOW // 2 else size + WINDOW
    if text := "".join(held):
        yield text


def unpacked(pieces: Iterator[bytes], note: Callable[[str], None]) -> Iterator[str]:
    """The text in some decoded bytes, in windows; nested compression is unwrapped."""
    heads: set[bytes] = set()
    head, pieces = _with_head(pieces, FEED)
    while head.startswith(MAGIC):
        digest = hashlib.sha256(head).digest()
        if digest in heads:  # it unpacks to itself or to what held it
            return
        heads.add(digest)
        read: list[bytes] = []
        inner, opened = _with_head(_unpack(_kept(pieces, read)), FEED)
        if not inner:  # not compressed data, it only begins like it
            pieces = itertools.chain(read, pieces)
            break
        read.append(None)
        head, pieces = inner, opened
    for part in _windows(pieces, note):
        if not isinstance(part, str):
            yield from unpacked(part, note)
            continue
        yield part
        if "\x00" in part:
            yield part.replace("\x00", "")


def _kept(pieces: Iterator[bytes], read: list) -> Iterator[bytes]:
    """The pieces, each put into ``read`` until that ends with None."""
    for piece in pieces:
        if not read or read[-1] is not None:
            read.append(piece)
        else:
            read[:] = [None]
        yield piece


def _layer_texts(raw: bytes, note: Callable[[str], None]) -> Iterator[str]:
    if len(raw) < PIECE and b"\x00" not in raw and not raw.startswith((*MAGIC, b"\xff\xfe", b"\xfe\xff")):
        yield raw.decode("utf-8", "replace")
    else:
        yield from unpacked((raw[i : i + PIECE] for i in range(0, len(raw), PIECE)), note)


def _children(layer: Layer, note: Callable[[str, int, int], None]) -> Iterator[Layer]:
    """The layers one step below, made when they are asked for; ``note`` gets text that is in none of them."""
    if "%" in layer.text or "\\" in layer.text or "&#" in layer.text:
        yield from decoded_in_place(layer)
    runs = ((m.start(), m.end(), m[0]) for m in BASE64.finditer(layer.text))
    for start, end, run in itertools.chain(runs, _blocks(layer.text) if "\n" in layer.text else ()):
        a, b = layer.original(start, end)
        for part in _layer_texts(_base64(run), lambda text, a=a, b=b: note(text, a, b)):
            if part:
                yield Layer(part, [0], [(a, b, False)])


def all_spans(text: str, most_decoded: int | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base spans, all spans with those of decoded layers, and 1 if ``most_decoded`` left layers unread."""
    base = base_spans(text)
    found = set(base)
    if not text:
        return base, base, 0

    # each entry: the layers to come and what was seen there; a large layer has a set of its own
    worklist: list[tuple[Iterator[Layer], tuple[set[bytes], ...]]] = []
    work = unread = 0

    def note(part: str, a: int, b: int) -> None:  # asked for inside the worklist, which goes on above it
        found.update((a, kind, b) for _, kind, _ in base_spans(part))
        if "\n" in part:
            follow(Layer(part, [0], [(a, b, False)]), (*worklist[-1][1], set()))

    def follow(top: Layer, seen: tuple[set[bytes], ...]) -> None:
        nonlocal work, unread
        depth = len(worklist)
        worklist.append((_children(top, note), seen))
        while len(worklist) > depth and not unread:
            layers, seen = worklist[-1]
            layer = next(layers, None)
            if layer is None:
                worklist.pop()
                continue
            place = b"%d:%d" % layer.original(0, len(layer.text))
            key = hashlib.sha256(place + b" " + layer.text.encode("utf-8", "surrogatepass")).digest()
            if any(key in s for s in seen):
                continue
            seen[-1].add(key)
            work += len(layer.text)
            if most_decoded is not None and work > most_decoded:
                unread = 1
                break
            for start, kind, end in base_spans(layer.text):
                a, b = layer.original(start, end)
                found.add((a, kind, b))
            worklist.append((_children(layer, note), (*seen, set()) if len(layer.text) >= PIECE else seen))
        del worklist[depth:]

    follow(Layer(text, [0], [(0, len(text), True)]), (set(),))
    return base, sorted(found), unread


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_spans", pa.string()),
        ("spans", pa.string()),
        ("n_unread", pa.int64()),
    ]
)


def secret_scan(docs: DataFrame, most_decoded: int | None = None) -> DataFrame:
    """One row per document: doc_id, how many base spans of each kind, base_spans, all spans, n_unread."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in batch.column("text"):
                base, every, unread = all_spans(text.as_py(), most_decoded)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                for col, value in zip(cols, (*counts, spelled(base), spelled(every), unread)):
                    col.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in cols]], schema=SCHEMA)

    return id_text(docs).mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string, n_unread long"
    )
