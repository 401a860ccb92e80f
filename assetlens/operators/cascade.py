"""The evidence cascade run end to end: every stage reads only the products that no earlier one resolved."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import evidence as E
from .materialize import materialize

OPEN = ["Not Found", "No Indication Text"]
USABLE = ["Matched", "Ambiguous"]


@dataclass
class EvidenceSources:
    """Landed tables of the stages.

    labels: label rows as `evidence.label_groups` takes them. listing: setid, title, published, listed_apps,
    document_apps, ingredient_names, text, statement and, if any, ordinal. titles: product_id, title observed
    before. overviews: application, html. label_texts: url, text. families: brand_key, application, ingredients.
    """

    labels: DataFrame
    listing: DataFrame
    titles: DataFrame
    overviews: DataFrame
    label_texts: DataFrame
    families: DataFrame


class EvidenceCascade:
    """Stages in order; `verdicts` holds the written rows of each, for the products that reached it."""

    def __init__(self, products: DataFrame, sources: EvidenceSources):
        self.products = materialize(E.prepare_products(products), "products")
        self.groups = materialize(E.label_groups(sources.labels), "label_groups")
        self.sources = sources
        self.verdicts: dict[str, DataFrame] = {}

    def stages(self):
        s = self.sources
        yield "application", lambda p: E.by_application(p, self.groups)
        yield "brand", lambda p: E.by_brand(p, self.groups, s.families)
        yield "spl", lambda p: E.by_spl(p, s.listing, s.titles)
        yield "spl_brand", lambda p: E.by_listing_brand(p, s.listing, s.families)
        yield "application_page", lambda p: E.by_application_page(p, s.overviews, s.label_texts)

    def run(self) -> DataFrame:
        """One row per product: the stage that decided, its verdict, and the trail of all stages that ran.

        The first stage settles a product unless it found nothing or no text; a later one only when it is
        usable. What a stage leaves open is written, so no stage runs the ones before it again."""
        left = self.products
        for i, (name, stage) in enumerate(self.stages()):
            rows = materialize(stage(left), f"verdict_{name}")
            self.verdicts[name] = rows
            settled = ~F.col("status").isin(OPEN) if i == 0 else F.col("status").isin(USABLE)
            left = materialize(E.residual(left, rows.filter(settled), "product_id"), f"after_{name}")
        self.left = left
        return E.cascade(self.products, list(self.verdicts.values()))

    def diagnostics(self) -> DataFrame:
        """(stage, status, products) over every stage that ran."""
        counts = [d.groupBy("stage", "status").agg(F.count("*").alias("products")) for d in self.verdicts.values()]
        out = counts[0]
        for c in counts[1:]:
            out = out.unionByName(c)
        return out
