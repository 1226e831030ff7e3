"""The public functions: catalog pages, texts in force, neighbourhoods, statistics and search over a set of tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalog as C
from ..operators import graph, jurimetrics, quality, search, taxonomy, validity

SEARCH_LIMIT, GRAPH_LIMIT, PAGE_LIMIT = 50, 200, 500


@dataclass(frozen=True)
class Library:
    """The tables of one knowledge base; any of them may be missing until it is needed."""

    catalog: DataFrame | None = None
    articles: DataFrame | None = None
    affectations: DataFrame | None = None
    versions: DataFrame | None = None
    chunks: DataFrame | None = None
    nodes: DataFrame | None = None
    edges: DataFrame | None = None

    def _need(self, name: str) -> DataFrame:
        found = getattr(self, name)
        if found is None:
            raise search.IndexMissing(f"table {name!r} is not loaded")
        return found

    def stats(self) -> DataFrame:
        return C.dashboard(self._need("catalog"))

    def page(self, limit: int = 50, offset: int = 0, **filters) -> DataFrame:
        """A catalog page; filters as for ``catalog_page``."""
        return C.catalog_page(self._need("catalog"), limit=min(limit, PAGE_LIMIT), offset=offset, **filters)

    def page_after(self, last: tuple[str | None, str | None, int] | None = None, limit: int = 50, **filters) -> DataFrame:
        """The catalog rows that follow ``last`` (anio, numero, id of a page's last row) in the order of ``page``.

        A filter in place of an offset: no page sorts or passes over the rows of the pages before it.
        """
        rows = C.filter_catalog(self._need("catalog"), **filters)
        if last is not None:
            anio, numero, ident = last
            # falling, nulls last: what follows is less or, where the last value is not null, null
            less = lambda c, v: F.lit(False) if v is None else F.col(c).isNull() | (F.col(c) < v)
            same = lambda c, v: F.col(c).eqNullSafe(F.lit(v))
            rows = rows.where(less("anio", anio) | (same("anio", anio) & (less("numero", numero) | (same("numero", numero) & (F.col("id") > ident)))))
        return rows.orderBy(F.desc("anio"), F.desc("numero"), "id").limit(min(limit, PAGE_LIMIT))

    def document(self, canonical: str) -> dict[str, DataFrame]:
        """Everything about one norm or ruling: its catalog row, articles, chunks, validity and neighbours, each a filtered table."""
        row = self._need("catalog").where(F.col("canonical_id") == canonical)
        below = F.col("canonical_id").startswith(f"{canonical}:art:")
        known = {"catalog": row}
        if self.articles is not None:
            known["articles"] = self.articles.where((F.col("canonical_id") == canonical) | below)
        if self.chunks is not None:
            known["chunks"] = self.chunks.where(F.col("norm_canonical_id") == canonical)
        if self.affectations is not None:
            norms = row.select(F.col("suin_id").alias("doc_id"), F.coalesce("suin_vigencia", "vigencia").alias("vigencia"))
            known["validity"] = validity.norm_reports(norms, self.affectations.join(norms.select("doc_id"), "doc_id", "left_semi"))
        if self.edges is not None:
            known["graph"] = graph.neighbourhood(self.edges, canonical, None, "ambas", GRAPH_LIMIT)
        return known

    def tree(self, query: str = "") -> DataFrame:
        """The library's tree, or what of it a search by name shows."""
        rows = self._need("catalog")
        placed = rows.select(taxonomy.classified(F.col("tipo"), F.col("sector"), F.col("entidad"), F.col("corte")).alias("x")).select("x.*")
        return taxonomy.library_order(taxonomy.library_filter(taxonomy.library_rollup(placed), query))

    def search(self, query: str, limit: int = 10, vector: list[float] | None = None, **filters) -> DataFrame:
        """BM25 over filtered chunks; with the query's ``vector``, fused with the nearest by the chunks' ``embedding``."""
        if not 1 <= limit <= SEARCH_LIMIT:
            raise ValueError(f"limit must be 1 to {SEARCH_LIMIT}")
        chunks = search.payload_filter(self._need("chunks"), **filters)
        asked = chunks.sparkSession.createDataFrame([(0, query)], "q int, query string")
        scored = search.bm25(chunks, "uid", "text", asked, "q", "query")
        if vector is None:
            found = search.top_per_query(scored, "q", "uid", limit)
        else:
            depth = search.prefetch_depth(limit)
            point = chunks.sparkSession.createDataFrame([(0, vector)], "q int, embedding array<double>")
            dense = search.nearest(chunks, point, "uid", "q", "embedding", depth, own=True)
            found = search.fuse([search.top_per_query(scored, "q", "uid", depth), dense], "q", "uid", limit)
        return found.join(chunks, "uid").select("uid", "canonical_id", "section", "body", F.round("score", 4).alias("score"), "rank").orderBy("rank")

    def text_in_force(self, canonical: str, date: str | None = None, article: str | None = None) -> DataFrame:
        """Text of an article at a date; the article may be part of the id."""
        norm, _, part = canonical.partition(":art:")
        wanted = f"{norm}:art:{article or part}"
        now = self._need("articles").where(F.col("canonical_id") == wanted).select("canonical_id", "text")
        past = self._need("versions").where(F.col("canonical_id") == wanted)
        at = None if date is None else text.any_date(F.lit(date))
        return validity.text_as_of(validity.version_timeline(past, now, ["canonical_id"]), ["canonical_id"], at)

    def validity(self) -> DataFrame:
        norms = self._need("catalog").select(F.col("suin_id").alias("doc_id"), F.coalesce("suin_vigencia", "vigencia").alias("vigencia"))
        return validity.norm_reports(norms, self._need("affectations"))

    def neighbours(self, node: str, relation: str | None = None, direction: str = "ambas", limit: int = 50) -> DataFrame:
        if not 1 <= limit <= GRAPH_LIMIT:
            raise ValueError(f"limit must be 1 to {GRAPH_LIMIT}")
        return graph.grouped_neighbours(graph.neighbourhood(self._need("edges"), node, relation, direction, limit))

    def statistics(self, top: int = 15, **filters) -> DataFrame:
        return jurimetrics.facets(jurimetrics.filtered_rulings(self._need("catalog").where("tipo = 'SENTENCIA'"), **filters), top=top)

    def verify(self) -> DataFrame:
        done = self._need("catalog").where("scrape_status = 'done'")
        stored = self._need("chunks").select(F.col("norm_canonical_id").alias("canonical_id"))
        return quality.all_checks([quality.reconciliation(done, stored, "canonical_id"), quality.completeness(done, stored, "canonical_id", F.xxhash64("canonical_id")), quality.error_budget(self._need("catalog"))])
