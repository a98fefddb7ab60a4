"""One row for every way of rendering a long document."""

from __future__ import annotations

from dataclasses import dataclass

from docflow.functions.titles import CURLY, QUOTED


@dataclass(frozen=True)
class Profile:
    name: str
    cleaning: str  # "basic" or "pages"
    sections: str  # a key of operators.sections.HEADINGS, or "pages"
    max_chars: int
    batch: int
    paragraph_s: float
    sentence_s: float
    workers: int
    wrap_long: bool = False
    slug_length: int | None = None
    marks: str = QUOTED  # what bold titles lose


#: Fixed values of the seven renderings.
PROFILES = {
    p.name: p
    for p in (
        Profile("numbered_a", "basic", "numbered", 280, 8, 0.55, 0.15, 2),
        Profile("numbered_b", "basic", "bold_numbered", 280, 8, 0.55, 0.15, 2),
        Profile("bold_batch", "basic", "bold", 280, 8, 0.55, 0.15, 2, slug_length=40, marks=CURLY),
        Profile("bold_single", "basic", "bold", 180, 1, 0.50, 0.12, 1, slug_length=40),
        Profile("marked", "basic", "marked", 280, 8, 0.55, 0.15, 1, slug_length=40),
        Profile("any_heading", "basic", "any", 180, 1, 0.50, 0.12, 1, slug_length=40),
        Profile("pages", "pages", "pages", 200, 1, 0.55, 0.15, 3, wrap_long=True),
    )
}
SAMPLE_RATE = 24_000
