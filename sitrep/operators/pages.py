"""News rows from web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import html, text

# Pages that may name both tags: literally, or with an entity inside the property.
_MAYBE_OG = r"""(?i)property\s*=\s*["']?[^"'>\s]*&"""


def og_extract(
    pages: DataFrame, url: str = "url", col: str = "html", now: Column | None = None
) -> DataFrame:
    """News rows of the pages with an og:image and an og:description tag.

    ``col`` is text, or bytes whose encoding is worked out per page. Pages that
    cannot qualify never leave the JVM.
    """
    as_text = F.col(col).cast("string")
    candidates = pages.select(F.col(url).alias("url"), F.col(col).alias("page")).where(
        (as_text.contains("og:image") & as_text.contains("og:description")) | as_text.rlike(_MAYBE_OG)
        # Wide encodings hide the ASCII letters from the tests above.
        | as_text.contains("\x00")
    )

    def extract(batches):
        import pyarrow as pa

        names = ["url", "image", "description", "title"]
        for batch in batches:
            out = []
            # One page at a time is a Python object.
            for address, page in zip(batch.column("url"), batch.column("page")):
                address, page = address.as_py(), page.as_py()
                if isinstance(page, bytes):
                    page = html.decode_page(page)
                found = html.open_graph(page)
                if found:
                    out.append((address, *found))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names)

    found = candidates.mapInArrow(extract, "url string, image string, description string, title string")
    return found.select(
        F.col("url").alias("source_url"),
        F.lit(C.NEWS_SOURCE_TYPE).alias("source_type"),
        F.col("description").alias("content"),
        "title",
        F.array("image").alias("media_urls"),
        text.iso_timestamp(F.current_timestamp() if now is None else now).alias("timestamp"),
    )


def register_sql(spark: SparkSession) -> None:
    """Table functions for SQL: ``og_extract(html)`` and ``glossary_rows(html)``."""

    class OgExtract:
        def eval(self, page: str):
            found = html.open_graph(page) if page is not None else None
            if found:
                yield found

    class GlossaryRows:
        def eval(self, page: str):
            yield from enumerate(html.element_texts(page or ""))

    spark.udtf.register("og_extract", F.udtf(OgExtract, returnType="image string, description string, title string", useArrow=True))
    spark.udtf.register("glossary_rows", F.udtf(GlossaryRows, returnType="row_no bigint, text string", useArrow=True))
