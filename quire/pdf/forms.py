"""Form fields of PDF files, form files, pages that are one image."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from quire.pdf.objects import Name, Pdf, PdfError, Stream, as_text_string, text_string, write
from quire.pdf.text import glyphs

#: A4 in points.
A4 = (595.0, 842.0)


def widgets(pdf: Pdf) -> Iterator[tuple[int, dict]]:
    """(page, dictionary) of each form widget."""
    for i, (_, page) in enumerate(pdf.pages()):
        for a in map(pdf.get, pdf.get(page.get("Annots")) or []):
            if isinstance(a, dict) and pdf.get(a.get("Subtype")) == "Widget":
                yield i, a


def widget_name(pdf: Pdf, w: dict) -> str:
    while isinstance(w, dict) and "T" not in w and "Parent" in w:
        w = pdf.get(w["Parent"])
    return text_string(pdf.get(w.get("T"))) or "<unnamed>"


def widget_parts(pdf: Pdf, w: dict) -> dict[str, str | None]:
    """What a widget shows: value, default_value, appearance, background; None for what it lacks."""
    mk = pdf.get(w.get("MK")) or {}
    show = lambda v: text_string(v) if isinstance(v, (bytes, str)) else write(v).decode("latin-1")
    part = lambda at, key: show(pdf.get(at[key])) if key in at and pdf.get(at[key]) is not None else None
    return {"value": part(w, "V"), "default_value": part(w, "DV"), "appearance": "present" if pdf.get(w.get("AP")) is not None else None, "background": part(mk, "BG")}


def clear_widgets(pdf: Pdf) -> int:
    """Take value, default, appearance and background from every widget and the values from the form; how many widgets had any."""
    changed = 0
    for _, w in widgets(pdf):
        had = {k for k in ("V", "DV", "AP") if w.pop(k, None) is not None}
        mk = pdf.get(w.get("MK"))
        if isinstance(mk, dict) and mk.pop("BG", None) is not None:
            had.add("BG")
        changed += bool(had)

    def clear(refs: object, depth: int) -> None:
        for f in map(pdf.get, pdf.get(refs) or []):
            if isinstance(f, dict) and depth < 32:
                f.pop("V", None)
                f.pop("DV", None)
                clear(f.get("Kids"), depth + 1)

    form = pdf.get(pdf.root.get("AcroForm"))
    try:
        if isinstance(form, dict):
            clear(form.get("Fields"), 0)
    finally:
        del clear  # it names itself, and would hold the file until the garbage is collected
    return changed


def blank_widgets(pdf: Pdf, only_set: bool = False) -> int:
    """Set every widget's value to the empty string and drop its appearance; how many had a value.

    only_set: leave widgets without a value as they are, but for their appearance.
    """
    had = 0
    for _, w in widgets(pdf):
        value = pdf.get(w.get("V"))
        had += bool(text_string(value)) if isinstance(value, (bytes, str)) else bool(value)
        if "V" in w or not only_set:
            w["V"] = b""
        w.pop("AP", None)
    return had


def form_file(title: str, fields: list[tuple[str, str, str, list[float]]], size: tuple[float, float] = A4) -> bytes:
    """A one-page form; fields: name, label, value, box (shares of the page, origin top left)."""
    pdf = Pdf()
    w, h = size
    n = lambda *v: b" ".join(write(float(x)) for x in v)
    font = pdf.add({"Type": Name("Font"), "Subtype": Name("Type1"), "BaseFont": Name("Helvetica"), "Encoding": Name("WinAnsiEncoding")})
    text = lambda x, y, s, t: b"BT /Helv " + n(s) + b" Tf " + n(x, y) + b" Td " + write(t.encode("cp1252", "replace")) + b" Tj ET\n"
    body, refs = text(0.08 * w, 0.92 * h, 16, title), []
    for name, label, value, box in fields:
        x0, y0, x1, y1 = box[0] * w, h - box[3] * h, box[2] * w, h - box[1] * h
        body += text(0.08 * w, y0 + 6, 10, label) + n(x0, y0, x1 - x0, y1 - y0) + b" re S\n"
        shown = b"/Tx BMC q BT /Helv 10 Tf 0 g 2 6 Td " + write(value.encode("cp1252", "replace")) + b" Tj ET Q EMC"
        look = pdf.add(Stream({"Type": Name("XObject"), "Subtype": Name("Form"), "BBox": [0, 0, x1 - x0, y1 - y0], "Resources": {"Font": {"Helv": font}}}, shown))
        refs.append(pdf.add({
            "Type": Name("Annot"), "Subtype": Name("Widget"), "FT": Name("Tx"), "T": as_text_string(name), "TU": as_text_string(label), "V": as_text_string(value), "DA": b"/Helv 10 Tf 0 g", "F": 4,
            "Rect": [x0, y0, x1, y1], "MK": {"BG": [0.92, 0.95, 1.0]}, "AP": {"N": look},
        }))
    page = pdf.add_page({"MediaBox": [0, 0, w, h], "Resources": {"Font": {"Helv": font}}, "Contents": pdf.add(Stream({}, body)), "Annots": refs})
    for r in refs:
        pdf.objects[r.n]["P"] = page
    pdf.root["AcroForm"] = pdf.add({"Fields": refs, "DR": {"Font": {"Helv": font}}, "DA": b"/Helv 10 Tf 0 g"})
    return pdf.save()


def _only_image(pdf: Pdf, page: dict) -> Stream:
    resources = pdf.get(page.get("Resources")) or {}
    images = [s for s in map(pdf.get, (pdf.get(resources.get("XObject")) or {}).values()) if isinstance(s, Stream) and s.head.get("Subtype") == "Image"]
    if len(images) != 1 or any(g.text.strip() for g in glyphs(pdf, page)):
        raise PdfError("a page of text and drawings needs a rasteriser")
    return images[0]


def page_jpeg(pdf: Pdf, page: dict) -> bytes | None:
    """The JPEG file that a page consists of; None if it is another kind of page."""
    try:
        image = _only_image(pdf, page)
    except PdfError:
        return None
    kind = pdf.get(image.head.get("Filter"))
    kind = [pdf.get(k) for k in kind] if isinstance(kind, list) else [kind]
    return image.raw if kind == ["DCTDecode"] else None


def page_image(pdf: Pdf, page: dict) -> np.ndarray:
    """The raster of a page that is one uncompressed or deflated image of 8-bit grey or RGB; other pages are an error."""
    image = _only_image(pdf, page)
    head = {k: pdf.get(v) for k, v in image.head.items()}
    channels = {"DeviceRGB": 3, "DeviceGray": 1}.get(head.get("ColorSpace") if isinstance(head.get("ColorSpace"), str) else "")
    if head.get("BitsPerComponent") != 8 or channels is None:
        raise PdfError("only images of 8-bit grey or RGB are read")
    data = np.frombuffer(pdf.decoded(image), np.uint8)
    shape = (head["Height"], head["Width"], channels)
    if data.size < shape[0] * shape[1] * channels:
        raise PdfError("the image is cut off")
    out = data[: shape[0] * shape[1] * channels].reshape(shape)
    return np.repeat(out, 3, 2) if channels == 1 else out


def image_pages(pages: list[np.ndarray], dpi: int = 150, titles: list[str] | None = None) -> bytes:
    """A file with a page for each RGB raster and a bookmark for each title (the pages from the first on)."""
    import zlib

    if not pages:
        raise ValueError("a PDF needs a page")
    pdf, refs = Pdf(), []
    for image in pages:
        h, w = image.shape[:2]
        raw = zlib.compress(np.ascontiguousarray(image, np.uint8).tobytes())
        look = pdf.add(Stream({"Type": Name("XObject"), "Subtype": Name("Image"), "Width": w, "Height": h, "ColorSpace": Name("DeviceRGB"), "BitsPerComponent": 8, "Filter": Name("FlateDecode")}, raw))
        pw, ph = w * 72 / dpi, h * 72 / dpi
        draw = b" ".join(write(float(x)) for x in (pw, 0, 0, ph, 0, 0)) + b" cm /I Do"
        refs.append(pdf.add_page({"MediaBox": [0, 0, pw, ph], "Resources": {"XObject": {"I": look}}, "Contents": pdf.add(Stream({}, draw))}))
    pdf.bookmarks([(t, refs[min(i, len(refs) - 1)]) for i, t in enumerate(titles or [])])
    return pdf.save()


