"""Optional page images: a renderer is injected, since none is a requirement of this package."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame


def page_texts(files: DataFrame, pages: Callable[[bytes], list[str]]) -> DataFrame:
    """binaryFile rows → path, page, text; a file that fails gives one row with a null text."""

    def run(frames):
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"]):
                try:
                    rows += [(path, k, t) for k, t in enumerate(pages(content), 1)]
                except Exception:  # noqa: BLE001  a damaged file is a row without text
                    rows.append((path, 1, None))
            yield pd.DataFrame(rows, columns=["path", "page", "text"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, text string")


def upload_side(dpi):
    """Longest side of a page image for a resolution."""
    from pyspark.sql import functions as F

    return F.least(F.lit(3600), F.greatest(F.lit(1800), dpi * 6))
