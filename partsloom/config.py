"""Validated configuration of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path


#: What the extractor is told, in this engine's words. Fixed values in it: column names, labels and examples of codes.
INSTRUCTIONS = """\
Read one page image of a technical manual and return its parts list as tab-separated text.

Columns, in this order, under a header line of their names: item_no, part_no, description, uoc, quantity.
Plain text only: no code fences, no comments, no blank lines, no further columns.

Pages without a parts list
- A parts list has columns for an item number, a part number, a description and a quantity. Any other page (effective
  pages, part number or stock number index, alphabetical list, cross reference, drawing) gives the header line alone.

Where values stand
- item_no: under ITEM NO, ITEM NUMBER, (b) or the like. Each item number gives exactly one line.
- part_no: under PART NUMBER, PART NO, P/N or the like. The maker's part number only: not the source code of five letters
  (SMR, such as PAHZZ), not the 13-digit stock number (NSN), not the maker's 5-character code (CAGEC). Empty if there is none.
- description: under DESCRIPTION or NOMENCLATURE.
- uoc: the codes behind "UOC:" on lines inside the description cell; several such lines are joined by a blank. Empty if there
  is no such line. Tags that point to a figure and item, such as "2) 208-14", are not codes.
- quantity: under QTY, Q or QUANTITY, usually the last column; a number, or empty where the cell is.

Description lines
- A line that carries the phrase of the line above on (a word or measure that was broken) belongs to the description; join
  such lines by a blank. A line that begins another part's name does not.
- Kits list their components below the item, and each component's line has a figure and item tag of its own beside it. Leave
  out all of these lines and their text; they give no lines of their own either.
- Rows of three dots or more only fill space: drop them and keep the words before and behind them. Drop dots or bullets a
  description begins with.
- A line that begins with "UOC:" never goes into the description.
- Read digits as digits: a zero is never the letter O.
"""
REQUEST = "Return the parts list of this image: the header line first, then one line for each item number, tab-separated, nothing else."


@dataclass(frozen=True)
class Config:
    provider: str = "stub"
    providers: dict = field(default_factory=dict)
    results_dir: str = ""
    datasets: tuple[str, ...] | None = None  # None: all
    tables_subdir: str = "tables"
    output_subdir: str = "table_data"
    output_dir: str = ""
    skip_existing: bool = True
    delay_seconds: float = 0.3
    max_retries: int = 3
    retry_backoff: float = 2.0
    calls: int = 1  # partitions that call the extractor at once; the rate is calls / delay_seconds
    system_prompt: str = INSTRUCTIONS
    user_prompt: str = REQUEST

    def layout(self, override: str = "") -> tuple[str, str]:
        """(layout, folder) of page tables: `apart` below a folder of their own when one is named on the command line,
        or where no `output_subdir` is set; else `beside` the images."""
        if override:
            return "apart", override
        return ("beside", self.results_dir) if self.output_subdir else ("apart", self.output_dir)

    @classmethod
    def of(cls, raw: dict) -> Config:
        """From the parsed file: `provider`, a block per provider and `pipeline`."""
        pipeline = dict(raw.get("pipeline") or {})
        sets = pipeline.pop("datasets", "*")
        if sets == "*" or sets is None:
            sets = None
        elif isinstance(sets, str):
            raise ValueError("pipeline.datasets must be '*' or a list of names")
        known = set(cls.__dataclass_fields__)
        unknown = set(pipeline) - known
        if unknown:
            raise ValueError(f"unknown pipeline settings: {', '.join(sorted(unknown))}")
        blocks = {k: v for k, v in raw.items() if k not in {"provider", "pipeline"}}
        return cls(provider=raw.get("provider", "anthropic"), providers=blocks, datasets=None if sets is None else tuple(sets), **pipeline)


def load_config(path: str) -> Config:
    import yaml

    return Config.of(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
