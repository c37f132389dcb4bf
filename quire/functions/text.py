"""Names, tags and paths."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Subtype tags, more telling ones first.
SUBTYPES = ("Short-Form", "Supplemental-Statement", "Initial-Registration", "Conflict-Part-Termination", "Amendment", "Statement", "Report", "Form", "Filing")
#: Roles by BIO tag number.
BIO_ROLES = {0: "other", 1: "header", 2: "header", 3: "question", 4: "question", 5: "answer", 6: "answer"}

#: White space, and what ends a line, in any alphabet.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LINE_END = r"\r\n|[\n-\r\x1c-\x1e\x85\u2028\u2029]"


def stripped(value: Column) -> Column:
    """Without the white space at both ends."""
    return F.regexp_replace(value, rf"\A{SPACE}+|(?<!{SPACE}){SPACE}+\z", "")


def lines(value: Column) -> Column:
    """The lines that hold more than white space, without that at their ends."""
    return F.filter(F.transform(F.split(value, LINE_END), stripped), lambda v: F.length(v) > 0)


def bio_role(tag: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in BIO_ROLES.items() for x in kv))[tag], F.lit("other"))


def title_label(name: Column) -> Column:
    """Underscores to spaces, every letter run capitalised."""
    runs = F.regexp_extract_all(F.replace(name, F.lit("_"), F.lit(" ")), F.lit(r"[\p{L}]+|[^\p{L}]+"), 0)
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))), "")


def subtype(name: Column, tags: tuple[str, ...] = SUBTYPES) -> Column:
    """The first tag, by priority, that stands in the name between underscores or its ends."""
    return F.coalesce(*(F.when(F.rlike(name, F.lit(f"(?:^|_){t}(?:_|$)")), F.lit(t)) for t in tags))


def source_of_stem(stem: Column, sources: list[str]) -> Column:
    """The longest known source that the file stem begins with, else what stands before the first underscore."""
    known = sorted(sources, key=lambda s: (-len(s), s))
    return F.coalesce(*(F.when((stem == s) | stem.startswith(s + "_"), F.lit(s)) for s in known), F.split_part(stem, F.lit("_"), F.lit(1)))


def safe_name(name: Column) -> Column:
    return F.translate(name, "/\\", "__")


def resolve_path(*candidates: Column, base: str = "") -> Column:
    """The first path that is not empty; relative ones begin at base."""
    path = F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates))
    return F.when(path.startswith("/") | F.rlike(path, F.lit("^[a-zA-Z][a-zA-Z0-9+.-]*://")), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/" if base else ""), path))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.[^./\\]+$", 0))


def is_pdf(path: Column) -> Column:
    return suffix(path) == ".pdf"


def render_path(path: Column, source: Column, source_fmt: Column) -> Column:
    """How a page becomes pixels."""
    form = is_pdf(path) & source.startswith("synthetic_") & (source_fmt != "image")
    return F.when(form, "acroform-clear").when(is_pdf(path), "pdf").otherwise("image")


def page_image_candidates(base: Column, page: Column) -> Column:
    """The names a page's image may have, best first."""
    stem = F.regexp_replace(base, r"\.[^./\\]+$", "")
    end = F.regexp_extract(base, r"\.[^./\\]+$", 0)
    number = F.format_string("%03d", page)
    numbered = F.regexp_replace(base, "_p000", F.concat(F.lit("_p"), number))
    return F.when(page == 0, F.array(base)).when(base.contains("_p000"), F.array(numbered)).otherwise(F.array(F.concat(stem, F.lit("_p"), number, end)))


def degradable(source: Column, sources: tuple[str, ...] = ("funsd", "xfund_de", "xfund_fr", "vrdu_registration", "vrdu_ad_buy")) -> Column:
    return source.isin(*sources) | source.startswith("synthetic_")


def seed_split(seed: Column) -> Column:
    """Seven, one and two of ten."""
    v = F.pmod(seed, F.lit(10))
    return F.when(v < 7, "train").when(v < 8, "val").otherwise("test")


#: Fixed value: the wording of a review caption.
CAPTION = "%s  |  %d clusters  %d gaps  %d dots stamped"


def caption(doc_id: Column, dots: Column, clusters: Column, gaps: Column, notes: Column, logged: Column | None = None) -> Column:
    """The footer of a reviewed document; one that the run log does not know (not logged) has its id alone."""
    n = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    counts = F.format_string(CAPTION, doc_id, n(clusters), n(gaps), n(dots))
    whole = F.when(F.size(notes) > 0, F.concat(counts, F.lit("  |  "), F.array_join(notes, ", "))).otherwise(counts)
    return whole if logged is None else F.when(logged, whole).otherwise(doc_id)


def parse_list(text: str) -> list[str]:
    """A file's lines or comma-separated names."""
    parts = Path(text).read_text(encoding="utf-8").splitlines() if text and Path(text).is_file() else text.split(",")
    return [p.strip() for p in parts if p.strip()]


def seeded(seed: int, *parts: Column) -> Column:
    """A rank key that any engine computes alike: md5 of seed and ids."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(p.cast("string") for p in parts)))
