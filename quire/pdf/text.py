"""Text on PDF pages: where each glyph stands, removal of glyphs, new text.

Places are in points from the top left corner of the page, as page rasters count them.  Widths come from the font; the
standard fonts, which carry none, are taken as Helvetica or, by name, Courier.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import cache
from typing import Any, NamedTuple

from quire.pdf.objects import Name, Op, Pdf, PdfError, Reader, Ref, Stream, write

#: Advance widths of Helvetica from space to tilde.
HELVETICA = (
    "278 278 355 556 556 889 667 191 333 333 389 584 278 333 278 278 556 556 556 556 556 556 556 556 556 556 278 278 584 584 584 556 1015 667 667 722 722 667 611 778 722 278 500 667 556 833 722 778 667 778 722 667 611 722 667 944 667 667 611 278 278 278 469 556 "
    "333 556 556 500 556 556 278 556 556 222 222 500 222 833 556 556 556 556 333 500 278 556 500 722 500 500 500 334 260 334 584"
)
ASCENT, DESCENT = 0.8, -0.2
DEEP = 12

Matrix = tuple[float, float, float, float, float, float]
IDENTITY: Matrix = (1, 0, 0, 1, 0, 0)


def times(a: Matrix, b: Matrix) -> Matrix:
    return (
        a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3],
        a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5],
    )


@cache
def _helvetica() -> dict[int, float]:
    return dict(enumerate(map(float, HELVETICA.split()), 32))


@cache
def _glyph_names() -> dict[str, str]:
    """Names of the commoner glyphs by rule: accented letters, digits, a few signs."""
    out = dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True))
    out |= dict(zip("space period comma hyphen colon semicolon slash parenleft parenright quotesingle quotedbl ampersand at numbersign dollar percent plus equal underscore question exclam".split(), " .,-:;/()'\"&@#$%+=_?!", strict=True))
    out |= {"germandbls": "ß", "quoteright": "’", "quoteleft": "‘", "endash": "–", "emdash": "—", "bullet": "•"}
    for accent in ("acute", "grave", "circumflex", "dieresis", "tilde", "cedilla", "caron", "ring"):
        word = {"dieresis": "DIAERESIS", "ring": "RING ABOVE"}.get(accent, accent.upper())
        for c in "AEIOUYCNSZaeiouycnsz":
            try:
                out[c + accent] = unicodedata.lookup(f"LATIN {'CAPITAL' if c.isupper() else 'SMALL'} LETTER {c.upper()} WITH {word}")
            except KeyError:
                continue
    return out


@cache
def _letters(codec: str) -> dict[int, str]:
    return {c: bytes([c]).decode(codec, "replace") for c in range(256)}


class Font:
    def __init__(self, pdf: Pdf, head: dict) -> None:
        get = pdf.get
        self.wide = head.get("Subtype") == "Type0"
        self.to_text: dict[int, str] = {}
        self.missing = 0.0
        widths: dict[int, float] = {}
        if self.wide:
            below = get((get(head.get("DescendantFonts")) or [{}])[0]) or {}
            self.missing = float(get(below.get("DW", 1000)))
            w = [get(x) for x in get(below.get("W")) or []]
            i = 0
            while i + 1 < len(w):
                if isinstance(w[i + 1], list):
                    widths |= {w[i] + k: float(get(x)) for k, x in enumerate(w[i + 1])}
                    i += 2
                else:
                    widths |= dict.fromkeys(range(w[i], w[i + 1] + 1), float(w[i + 2])) if i + 2 < len(w) else {}
                    i += 3
        else:
            first, listed = get(head.get("FirstChar", 0)), get(head.get("Widths"))
            base = str(get(head.get("BaseFont")) or "")
            if listed:
                widths = {first + i: float(get(x)) for i, x in enumerate(listed)}
                self.missing = float(get((get(head.get("FontDescriptor")) or {}).get("MissingWidth", 0)))
            else:
                self.missing = 600.0 if "Courier" in base else 556.0
                widths = {} if "Courier" in base else _helvetica()
            encoding = get(head.get("Encoding"))
            table = encoding if isinstance(encoding, str) else (encoding or {}).get("BaseEncoding", "")
            codec = "mac_roman" if table == "MacRomanEncoding" else "cp1252"
            self.to_text = dict(_letters(codec))
            if isinstance(encoding, dict):
                at = 0
                for x in map(get, get(encoding.get("Differences")) or []):
                    if isinstance(x, int):
                        at = x
                    else:
                        n = str(x)
                        self.to_text[at] = n if len(n) == 1 else chr(int(n[3:7], 16)) if re.fullmatch(r"uni[0-9A-F]{4,}", n) else _glyph_names().get(n, self.to_text.get(at, ""))
                        at += 1
        self.widths = widths
        cmap = get(head.get("ToUnicode"))
        if isinstance(cmap, Stream):
            self._cmap(pdf.decoded(cmap))

    def _cmap(self, data: bytes) -> None:
        number = lambda v: int.from_bytes(v, "big")
        text = lambda v: v.decode("utf-16-be", "replace")
        for kind, body in re.findall(rb"beginbf(char|range)(.*?)endbf", data, re.S):
            r, values = Reader(body), []
            try:
                while True:
                    values.append(r.value())
            except EOFError:
                pass
            if kind == b"char":
                self.to_text |= {number(a): text(b) for a, b in zip(values[::2], values[1::2], strict=False) if isinstance(b, bytes)}
            else:
                for a, z, b in zip(values[::3], values[1::3], values[2::3], strict=False):
                    for k in range(min(number(z) - number(a) + 1, 1 << 16)):
                        if isinstance(b, list):
                            if k < len(b):
                                self.to_text[number(a) + k] = text(b[k])
                        else:
                            self.to_text[number(a) + k] = text(b[:-2] + (number(b[-2:]) + k & 0xFFFF).to_bytes(2, "big"))

    def codes(self, s: bytes) -> list[tuple[bytes, int]]:
        step = 2 if self.wide else 1
        return [(s[i : i + step], int.from_bytes(s[i : i + step], "big")) for i in range(0, len(s) - step + 1, step)]


class Glyph(NamedTuple):
    text: str
    x0: float
    y0: float
    x1: float
    y1: float
    size: float
    base_x: float
    base_y: float


@dataclass
class _State:
    ctm: Matrix = IDENTITY
    font: Font | None = None
    size: float = 0.0
    char: float = 0.0
    word: float = 0.0
    scale: float = 1.0
    lead: float = 0.0
    rise: float = 0.0
    tm: Matrix = IDENTITY
    line: Matrix = IDENTITY


@dataclass
class _Pass:
    """One run over a page: glyphs found, and the content without those that gone picks."""

    pdf: Pdf
    box: tuple[float, float, float, float]
    gone: Any = None
    glyphs: list[Glyph] = field(default_factory=list)
    removed: int = 0
    fonts: dict[int, Font] = field(default_factory=dict)

    def font(self, ref: Any) -> Font | None:
        head = self.pdf.get(ref)
        if not isinstance(head, dict):
            return None
        if id(head) not in self.fonts:
            self.fonts[id(head)] = Font(self.pdf, head)
        return self.fonts[id(head)]

    def show(self, st: _State, parts: list) -> list | None:
        """Walk the strings and shifts of a show operator; the parts that are left if any glyph goes."""
        out: list = []
        lost = False
        unit = st.size * st.scale or 1.0
        for part in parts:
            if not isinstance(part, bytes):
                shift = -float(part) / 1000 * st.size * st.scale
                st.tm = times((1, 0, 0, 1, shift, 0), st.tm)
                out.append(part)
                continue
            if st.font is None:
                out.append(part)
                continue
            kept = b""
            # along a string a matrix moves and does not turn
            t0, t1, t2, t3, t4, t5 = st.tm
            c0, c1, c2, c3, c4, c5 = st.ctm
            m0, m1, m2, m3, _, _ = times(st.tm, st.ctm)
            low, high, size = DESCENT * st.size + st.rise, ASCENT * st.size + st.rise, abs(st.size * (m2**2 + m3**2) ** 0.5)
            left, top = self.box[0], self.box[3]
            widths, missing, letters = st.font.widths, st.font.missing, st.font.to_text
            for raw, code in st.font.codes(part):
                width = widths.get(code, missing) / 1000
                step = (width * st.size + st.char + (st.word if raw == b" " else 0)) * st.scale
                m4, m5 = t4 * c0 + t5 * c2 + c4, t4 * c1 + t5 * c3 + c5
                w = width * unit
                xs = (low * m2 + m4 - left, high * m2 + m4 - left, w * m0 + low * m2 + m4 - left, w * m0 + high * m2 + m4 - left)
                ys = (top - (low * m3 + m5), top - (high * m3 + m5), top - (w * m1 + low * m3 + m5), top - (w * m1 + high * m3 + m5))
                g = Glyph(letters.get(code, ""), min(xs), min(ys), max(xs), max(ys), size, st.rise * m2 + m4 - left, top - (st.rise * m3 + m5))
                self.glyphs.append(g)
                t4, t5 = step * t0 + t4, step * t1 + t5
                st.tm = (t0, t1, t2, t3, t4, t5)
                if self.gone is not None and self.gone(g):
                    lost = True
                    self.removed += 1
                    if kept:
                        out.append(kept)
                        kept = b""
                    out.append(-step * 1000 / unit)
                else:
                    kept += raw
            if kept:
                out.append(kept)
        return out if lost else None

    def run(self, data: bytes, resources: dict, st: _State, depth: int = 0) -> bytes | None:
        """The content without the glyphs that go; None if none does."""
        get = self.pdf.get
        r, args, begin, out, done = Reader(data), [], 0, [], 0
        stack: list[_State] = []
        fonts, forms = get(resources.get("Font")) or {}, get(resources.get("XObject")) or {}
        r.skip()
        begin = r.at
        while True:
            try:
                v = r.value()
            except EOFError:
                break
            if not isinstance(v, Op):
                args.append(v)
                continue
            new: bytes | None = None
            try:
                if v == "BI":
                    m = re.compile(rb"\sID[\s].*?[\s]EI(?=\s|$)", re.S).search(data, r.at)
                    r.at = m.end() if m else len(data)
                elif v == "q":
                    stack.append(_State(**vars(st)))
                elif v == "Q" and stack:
                    st.__dict__.update(vars(stack.pop()))
                elif v == "cm":
                    st.ctm = times(tuple(map(float, args[-6:])), st.ctm)
                elif v == "BT":
                    st.tm = st.line = IDENTITY
                elif v == "Tf":
                    st.font, st.size = self.font(fonts.get(str(args[-2]))), float(args[-1])
                elif v in ("Tc", "Tw", "TL", "Ts"):
                    setattr(st, {"Tc": "char", "Tw": "word", "TL": "lead", "Ts": "rise"}[v], float(args[-1]))
                elif v == "Tz":
                    st.scale = float(args[-1]) / 100
                elif v in ("Td", "TD"):
                    if v == "TD":
                        st.lead = -float(args[-1])
                    st.tm = st.line = times((1, 0, 0, 1, float(args[-2]), float(args[-1])), st.line)
                elif v == "Tm":
                    st.tm = st.line = tuple(map(float, args[-6:]))
                elif v in ("T*", "'", '"'):
                    st.tm = st.line = times((1, 0, 0, 1, 0, -st.lead), st.line)
                    if v == '"':
                        st.word, st.char = float(args[-3]), float(args[-2])
                if v in ("Tj", "TJ", "'", '"'):
                    left = self.show(st, args[-1] if v == "TJ" else args[-1:])
                    if left is not None:
                        before = b"" if v in ("Tj", "TJ") else b"T* " if v == "'" else write(args[-3]) + b" Tw " + write(args[-2]) + b" Tc T* "
                        new = before + write([float(x) if isinstance(x, float) else x for x in left]) + b" TJ"
                elif v == "Do" and depth < DEEP:
                    form = get(forms.get(str(args[-1])))
                    if isinstance(form, Stream) and form.head.get("Subtype") == "Form":
                        inner = _State(**vars(st))
                        inner.ctm = times(tuple(float(get(x)) for x in get(form.head.get("Matrix")) or IDENTITY), st.ctm)
                        changed = self.run(self.pdf.decoded(form), get(form.head.get("Resources")) or resources, inner, depth + 1)
                        if changed is not None:
                            head = {k: x for k, x in form.head.items() if k not in ("Filter", "DecodeParms", "Length")}
                            name = f"R{len(self.pdf.objects)}"
                            forms[name] = self.pdf.add(Stream(head, changed))
                            new = write(Name(name)) + b" Do"
            except (IndexError, ValueError, TypeError) as e:
                if isinstance(e, PdfError):
                    raise
            if new is not None:
                out += [data[done:begin], new]
                done = r.at
            args = []
            r.skip()
            begin = r.at
        return b"".join([*out, data[done:]]) if out else None


def _own_resources(pdf: Pdf, page: dict) -> dict:
    """A copy of a page's resources that may be changed without touching other pages."""
    res = dict(pdf.get(page.get("Resources")) or {})
    for k in ("Font", "XObject"):
        res[k] = dict(pdf.get(res.get(k)) or {})
    return res


def glyphs(pdf: Pdf, page: dict) -> list[Glyph]:
    p = _Pass(pdf, pdf.media_box(page))
    p.run(pdf.contents(page), _own_resources(pdf, page), _State())
    return p.glyphs


def lines(found: list[Glyph]) -> list[list[Glyph]]:
    """Glyphs in runs that read on: the same base line, each where the last one ends or a word's gap behind it."""
    out: list[list[Glyph]] = []
    for g in found:
        last = out[-1][-1] if out else None
        if last is not None and abs(g.base_y - last.base_y) < 0.3 * max(g.size, 1) and -0.3 * g.size <= g.x0 - last.x1 < 1.5 * g.size:
            out[-1].append(g)
        else:
            out.append([g])
    return out


def read(run: list[Glyph]) -> tuple[str, list[int]]:
    """(text, glyph of each letter) of a run; a gap of a quarter of the size is a space."""
    text, owner = "", []
    for i, g in enumerate(run):
        if i and g.x0 - run[i - 1].x1 > 0.25 * g.size and not text.endswith(" ") and g.text != " ":
            text += " "
            owner.append(i)
        text += g.text
        owner += [i] * len(g.text)
    return text, owner


class Span(NamedTuple):
    x0: float
    y0: float
    x1: float
    y1: float
    text: str
    size: float
    base_x: float
    base_y: float


def spans(found: list[Glyph]) -> list[Span]:
    out = []
    for run in lines(found):
        text, _ = read(run)
        if text.strip():
            out.append(Span(min(g.x0 for g in run), min(g.y0 for g in run), max(g.x1 for g in run), max(g.y1 for g in run), text, run[0].size, run[0].base_x, run[0].base_y))
    return out


def inside(g: Glyph, box: tuple[float, float, float, float]) -> bool:
    """Whether a glyph's middle lies in a box."""
    return box[0] <= (g.x0 + g.x1) / 2 <= box[2] and box[1] <= (g.y0 + g.y1) / 2 <= box[3]


def search(found: list[Glyph], wanted: str, box: tuple[float, float, float, float]) -> list[Span]:
    """Where a text stands in a box, whatever its case."""
    out = []
    for run in lines([g for g in found if inside(g, box)]):
        text, owner = read(run)
        for m in re.finditer(re.escape(wanted), text, re.I):
            hit = run[owner[m.start()] : owner[m.end() - 1] + 1]
            out.append(Span(min(g.x0 for g in hit), min(g.y0 for g in hit), max(g.x1 for g in hit), max(g.y1 for g in hit), m[0], hit[0].size, hit[0].base_x, hit[0].base_y))
    return out


def redact(pdf: Pdf, ref: Ref, page: dict, boxes: list[tuple[float, float, float, float]]) -> int:
    """Take the glyphs in these boxes out of a page; drawings and images stay.  How many went."""
    res = _own_resources(pdf, page)
    p = _Pass(pdf, pdf.media_box(page), lambda g: any(inside(g, b) for b in boxes))
    content = p.run(pdf.contents(page), res, _State())
    if content is not None:
        pdf.objects[ref.n] |= {"Contents": pdf.add(Stream({}, content)), "Resources": res}
    return p.removed


def put_text(pdf: Pdf, ref: Ref, texts: list[tuple[float, float, float, str, tuple[float, float, float]]], strip: tuple[float, float, float, float] | None = None) -> None:
    """Write (x, y of the base line, size, text, colour) over a page in Helvetica, on a white strip if one is given."""
    page = dict(pdf.pages()[[r for r, _ in pdf.pages()].index(ref)][1])
    x_least, _, _, y_most = pdf.media_box(page)
    res = _own_resources(pdf, page)
    res["Font"]["QuireHelv"] = pdf.add({"Type": Name("Font"), "Subtype": Name("Type1"), "BaseFont": Name("Helvetica"), "Encoding": Name("WinAnsiEncoding")})
    n = lambda *v: b" ".join(write(float(x)) for x in v)
    body = b""
    if strip:
        body += b"1 1 1 rg " + n(x_least + strip[0], y_most - strip[3], strip[2] - strip[0], strip[3] - strip[1]) + b" re f\n"
    for x, y, size, text, color in texts:
        body += b"BT " + n(*color) + b" rg /QuireHelv " + n(size) + b" Tf " + n(x_least + x, y_most - y) + b" Td " + write(text.encode("cp1252", "replace")) + b" Tj ET\n"
    # the page's own content may leave its state changed
    whole = b"q\n" + pdf.contents(page) + b"\nQ\nq\n" + body + b"Q"
    pdf.objects[ref.n] |= {"Contents": pdf.add(Stream({}, whole)), "Resources": res}
