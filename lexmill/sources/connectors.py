"""Portal connectors as plans: raw pages or API items in, discovery seeds out.

Each parser takes a DataFrame with the raw column and returns seeds (tipo, numero, anio, source,
corte, canonical_id, external_id, source_url, subtipo, extra). Matches are found by regular
expressions in the JVM and exploded; duplicates keep the first in page order. Fetching pages is not
part of this module: raw pages come from files or tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.ids import canonical_id

SEED_COLUMNS = ("tipo", "numero", "anio", "source", "corte", "magistrado_ponente", "canonical_id", "external_id", "source_url", "subtipo", "extra")

# --- fixed values: patterns, names and addresses of the portals -------------------------------------
NORMOGRAM_NAME = r"(?i)([a-z_]+)_([a-z]+)_([0-9a-z\-]+)_(\d{4})\.html?$"
NORMOGRAM_TYPES = {"resolucion": "RESOLUCION", "oficio": "CONCEPTO", "concepto": "CONCEPTO", "concepto_tributario": "CONCEPTO", "circular": "CIRCULAR", "decreto": "DECRETO", "memorando": "CIRCULAR", "decision": "DECISION CAN"}
NORMOGRAM_PLURALS = {
    "resoluciones": "RESOLUCION",
    "oficios": "CONCEPTO",
    "conceptos": "CONCEPTO",
    "circulares": "CIRCULAR",
    "decretos": "DECRETO",
    "leyes": "LEY",
    "memorandos": "CIRCULAR",
    "sentencias": "SENTENCIA",
    "autos": "AUTO",
    "decisiones": "DECISION CAN",
    "directivas": "CIRCULAR",
    "acuerdos": "ACUERDO",
    "codigos": "CODIGO",
    "estatutos": "CODIGO",
    "constitucion": "CONSTITUCION",
}
JEP_ORIGIN = r"jep|sala|tribunal|acuerdo|resolucion|circular|objecion|documento|comisi[oó]n de g[eé]nero"
JEP_MIRROR = r"corte constitucional|consejo de estado|corte suprema|csj"
JEP_DOCS = "https://jurinfo.jep.gov.co/normograma/compilacion/docs/"
FIELD_STOP = r"NÚMERO DE PROCESO|NÚMERO DE PROVIDENCIA|CLASE DE ACTUACIÓN|TIPO DE PROVIDENCIA|FECHA|PONENTE|TEMA|FUENTE FORMAL|SALVAMENTO|ACTOR|DEMANDAD[OA]|DECISION|DECISIÓN|SUSTENTO NORMATIVO|NORMA DEMANDADA|SECCI[OÓ]N|NR|ID|$"
IACHR_PHASES = [
    ("Excepciones Preliminares, Fondo, Reparaciones y Costas", "fondo"),
    ("Excepción Preliminar, Fondo, Reparaciones y Costas", "fondo"),
    ("Fondo, Reparaciones y Costas", "fondo"),
    ("Sentencia de Fondo", "fondo"),
    ("Reparaciones y Costas", "reparaciones"),
    ("Excepciones Preliminares", "excepciones_preliminares"),
    ("Excepción Preliminar", "excepciones_preliminares"),
    ("Interpretación de la Sentencia", "interpretacion"),
    ("Interpretación", "interpretacion"),
    ("Fondo", "fondo"),
]
IACHR = "https://www.corteidh.or.cr"
COMPTROLLER_URL = r"(?i)/files/([^/]+)/(CGR-OJ|CGR%E2%80%93OJ|REG-EJE|OGZ)-?\s*(\d+)-(\d{4})\.pdf"
COMPTROLLER_LINK = r"(?i)(https://relatoria\.blob\.core\.windows\.net/\$web/files/[^\"'\s>]+?\.pdf)"
DISCIPLINE_NAME = r"(?i)([A-Z]?\d{20,24})ADJUNTA(\d{14})\.pdf"
DISCIPLINE_DOCS = "https://relatoria.cndj.gov.co/docs_relatoria"
BOGOTA_TITLE = r"^\s*([A-Za-zÁÉÍÓÚÑáéíóúñ.\s]+?)\s+([0-9][0-9A-Za-z\-]*)\s+de\s+(\d{4})\b(?:\s+(.*))?$"
BOGOTA_TYPES = {"decreto": "DECRETO", "acuerdo": "ACUERDO", "resolucion": "RESOLUCION", "resolución": "RESOLUCION", "circular": "CIRCULAR", "directiva": "CIRCULAR", "constitucion politica": "CONSTITUCION POLITICA", "constitución política": "CONSTITUCION POLITICA", "acto legislativo": "ACTO LEGISLATIVO", "ley": "LEY"}
BOGOTA = "https://www.alcaldiabogota.gov.co/sisjur/normas/Norma1.jsp?i="
BANK = "https://www.banrep.gov.co"
BANK_CELL = r'(?is)<td[^>]*class="[^"]*views-field-title[^"]*"[^>]*>(.*?)</td>'
EVA_TEXT = r"(?i)^\s*([A-Za-zÁÉÍÓÚÑáéíóúñ./ ]+?)\s+(?:N[°ºo.]*\s*)?([0-9][0-9A-Za-z\-/]*)\s+(?:de|del|of)\s+(\d{4})"
EVA_TYPES = {"ley": "LEY", "ley estatutaria": "LEY", "decreto": "DECRETO", "decreto unico": "DECRETO", "decreto único": "DECRETO", "decreto ley": "DECRETO", "decreto reglamentario": "DECRETO", "resolucion": "RESOLUCION", "resolución": "RESOLUCION", "circular": "CIRCULAR", "circular externa": "CIRCULAR EXTERNA", "concepto": "CONCEPTO", "acuerdo": "ACUERDO", "directiva": "CIRCULAR", "acto legislativo": "ACTO LEGISLATIVO", "constitucion politica": "CONSTITUCION POLITICA", "constitución política": "CONSTITUCION POLITICA"}
EVA_PDF = "https://www.funcionpublica.gov.co/eva/gestornormativo/norma_pdf.php?i="
CNE_TEXT = r"(?i)(Resoluci[oó]n|Concepto|Acuerdo)\s+(?:N[°ºo.]*\s*)?([0-9][0-9A-Za-z\-/]*)\s+(?:de|del)\s+(\d{4})"
CNE_FILE = r"(?i)(?:Res|Resoluci[oó]n)[.\s]*\s*(\d{2,6})\s+(?:de|del)\s+(20\d\d|19\d\d)"
GAZETTE = "https://svrpubindc.imprenta.gov.co/senado/index2.xhtml"
SUPERVISOR_TEXT = r"(?i)(Circular\s+Externa|Carta\s+Circular|Concepto|Resoluci[oó]n)\s+(?:N[°ºo.]*\s*)?([0-9][0-9A-Za-z\-]*)\s+de\s+(\d{4})"
SUPERVISOR_TYPES = {"circular externa": "CIRCULAR EXTERNA", "carta circular": "CIRCULAR EXTERNA", "concepto": "CONCEPTO", "resolucion": "RESOLUCION", "resolución": "RESOLUCION"}
FINANCE_LOADER = "https://www.superfinanciera.gov.co/jsp/loader.jsf?lServicio=Publicaciones&lTipo=publicaciones&lFuncion=loadContenidoPublicacion&id="
COURT_CHAMBERS = {"sala plena": "plena", "salas de revisión": "revision", "sala de revisión": "revision", "salas de revision": "revision", "sala de revision": "revision"}
LINK = r"(?is)<a\b[^>]*\bhref=[\"']?([^\"'>]+)[\"']?[^>]*>(.*?)</a>"


def matches(c: Column, pattern: str, groups: int) -> Column:
    """All matches of a pattern as array<struct<g1..gn>>, in order."""
    parts = [F.regexp_extract_all(c, F.lit(pattern), k).alias(f"g{k}") for k in range(1, groups + 1)]
    return F.arrays_zip(*parts)


#: Result links of the prosecutor's search (text before, text from the link on, address),
#: links to its pages, and the countries under the regional court.
PROSECUTOR_LINK = r"(?is)(.{0,600}?)(?=(href=.{0,595}))href=[\"']([^\"']*?/relatoria/media/file/[^\"']+)[\"']"
PROSECUTOR_PAGE = r"(?is)^.*href=[\"'][^\"']*?/guia/[^\"']*?/docs/[^\"'/]+?\.html?[\"']"
IACHR_COUNTRIES = (
    "Argentina", "Bolivia", "Brasil", "Chile", "Colombia", "Costa Rica", "Ecuador", "El Salvador", "Guatemala", "Haití", "Honduras",
    "México", "Nicaragua", "Panamá", "Paraguay", "Perú", "República Dominicana", "Suriname", "Trinidad y Tobago", "Uruguay", "Venezuela",
)


def leading_country(c: Column) -> Column:
    """The longest country name that a text starts with, accents aside; else its first word."""
    bare = F.lower(text.strip_accents(c))
    named = F.transform(F.filter(F.array(*map(F.lit, IACHR_COUNTRIES)), lambda p: F.startswith(bare, F.lower(text.strip_accents(p)))), lambda p: F.struct(F.length(p), p.alias("p")))
    return F.coalesce(F.array_max(named)["p"], F.get(F.split(c, " "), 0))


def group(c: Column, pattern: str, k: int) -> Column:
    """Group of the first match, null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))


def _each(df: DataFrame, raw: str, pattern: str, groups: int) -> DataFrame:
    return df.select("*", F.posexplode(matches(F.col(raw), pattern, groups)).alias("pos", "m"))


def _first(df: DataFrame, *keys: str) -> DataFrame:
    """First row of each key in page order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")


def _seeds(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Seed rows; columns not given are null; ``cid=True`` builds the canonical id."""
    none = F.lit(None).cast("string")
    given = {k: F.lit(v) if isinstance(v, str) else v for k, v in columns.items() if k != "cid"}
    rows = df.select("*", *[given.get(c, none if c != "extra" else F.lit(None).cast("map<string,string>")).alias(f"_s_{c}") for c in SEED_COLUMNS if c != "canonical_id" or "canonical_id" in given])
    if "canonical_id" not in given:
        made = canonical_id(F.col("_s_tipo"), F.col("_s_numero"), F.col("_s_anio"), F.col("_s_corte"), given.get("_sala")) if columns.get("cid", True) else none
        rows = rows.withColumn("_s_canonical_id", F.when(F.col("_s_anio").isNotNull() & F.col("_s_numero").isNotNull(), made))
    return rows.select(*[F.col(f"_s_{c}").alias(c) for c in SEED_COLUMNS])


def _year_within(c: Column, low: int, high: int) -> Column:
    return F.when(c.rlike(r"^\d{4}$") & c.cast("string").between(str(low), str(high)), c)


def _extra(**pairs: Column | str) -> Column:
    flat = []
    for k, v in pairs.items():
        flat += [F.lit(k), F.lit(v) if isinstance(v, str) else v]
    return F.map_filter(F.create_map(*flat), lambda k, v: v.isNotNull())


def normogram_links(df: DataFrame, url: str, source: str, entity: str) -> DataFrame:
    """Seeds of ``<type>_<entity>_<number>_<year>.htm`` addresses; other names are left out."""
    name = F.element_at(F.split(url, "/"), -1)
    kind = F.lower(F.regexp_extract(name, NORMOGRAM_NAME, 1))
    rows = df.where(name.rlike(NORMOGRAM_NAME)).withColumn("_y", _year_within(F.regexp_extract(name, NORMOGRAM_NAME, 4), 1900, 2030)).where("_y IS NOT NULL")
    tipo = F.coalesce(text.lookup(kind, NORMOGRAM_TYPES), F.replace(F.upper(kind), F.lit("_"), F.lit(" ")))
    return _seeds(rows, tipo=tipo, numero=F.regexp_extract(name, NORMOGRAM_NAME, 3), anio=F.col("_y"), source=source, source_url=F.col(url), extra=_extra(entidad=entity.upper()))


def normogram_items(df: DataFrame, source: str, entity: str, docs: str) -> DataFrame:
    """Seeds of API items (tipo, year, numero, entidad, link); unknown types fall back on the file name."""
    rows = df.where(F.trim("link") != "").withColumn("_t", text.lookup(F.lower(F.trim("tipo")), NORMOGRAM_PLURALS)).withColumn("_u", F.concat(F.lit(docs), F.trim("link")))
    known = rows.where("_t IS NOT NULL")
    year = _year_within(F.trim("year"), 1900, 2030)
    out = _seeds(known, tipo=F.col("_t"), numero=text.blank_to_null(F.col("numero")), anio=year, source=source, source_url=F.col("_u"), extra=_extra(entidad=F.coalesce(text.blank_to_null(F.col("entidad")), F.lit(entity))))
    return out.unionByName(normogram_links(rows.where("_t IS NULL"), "_u", source, entity))


def in_window(seeds: DataFrame, first: int, last: int) -> DataFrame:
    """Seeds of the years; unknown years pass."""
    return seeds.where(F.col("anio").isNull() | F.col("anio").between(str(first), str(last)))


def ruling_rows(df: DataFrame, html: str, corte: str, source: str, servlet: str) -> DataFrame:
    """Rows of a court's result table; labelled fields end at the next known label."""
    rows = _each(df, html, r'(?s)data-rk="(\d+)"[^>]*>(.*?)(?=data-rk="\d+"|\z)', 2).withColumn("t", text.strip_tags(F.col("m.g2")))
    t = F.col("t")
    field = lambda label: F.nullif(F.trim(group(t, label + r"\s*:?\s*(.*?)\s*(?:" + FIELD_STOP + r")\s*:", 1)), F.lit(""))
    docket = F.coalesce(field("NÚMERO DE PROCESO"), F.trim(group(t, r"\b([A-Z]?\s?\d{4,5}-?\d{2}-?\d{2}-?\d{3}[\d-]{6,})\b", 1)))
    chamber = F.initcap(F.coalesce(F.trim(group(t, r"(SALA\s+(?:DE\s+)?[A-ZÁÉÍÓÚÑ ]+?)\s+(?:TUTELA|ASUNTO|NR|ID|N[ÚU]MERO)", 1)), field("SECCI[OÓ]N")))
    code = F.coalesce(*[F.when(F.lower(chamber).contains(c), c) for c in ("laboral", "penal", "civil", "plena", "constitucional")], F.lit("plena"))
    loose = F.initcap(F.trim(group(t, r"\b((?:AUTO|SENTENCIA|CONCEPTO)(?:\s+[A-ZÁÉÍÓÚÑ]+)*?)(?=\s+(?:SUSTENTO|NORMA|FECHA|SECCI|PONENTE|ACTOR|TEMA|DECISI))", 1)))
    ident = F.col("m.g1")
    return _seeds(
        rows,
        tipo="SENTENCIA",
        numero=F.coalesce(field("NÚMERO DE PROVIDENCIA"), docket, ident),
        anio=group(t, r"FECHA\s*:?\s*\d{2}/\d{2}/(\d{4})", 1),
        source=source,
        corte=corte,
        _sala=code,
        magistrado_ponente=field("PONENTE"),
        external_id=ident,
        source_url=F.concat(F.lit(f"{servlet}?corp={corte}&ext=pdf&file="), ident),
        subtipo=F.coalesce(field("TIPO DE PROVIDENCIA"), loose),
        extra=_extra(radicado=docket, sala=chamber, descrip=t),
    )


def total_count(html: Column) -> Column:
    """N of "X / N" with thousands separators; 0 without it."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_replace(F.regexp_extract(html, r"\d+\s*/\s*([\d.,]+)", 1), "[.,]", ""), F.lit("")), F.lit("999999999999")).cast("long"), F.lit(0))


def iachr_listing(df: DataFrame, html: str) -> DataFrame:
    """(ficha, nombre) of a listing: each id once, with the first name that is not blank."""
    named = _each(df, html, r"(?i)ver_ficha_tecnica\.cfm\?nId_Ficha=(\d+)[^>]*>(?:\s*<[^>]+>)*\s*([^<]+)", 2).select(F.col("m.g1").alias("ficha"), F.nullif(text.collapse(F.col("m.g2")), F.lit("")).alias("nombre"), "pos")
    bare = _each(df, html, r"(?i)(nId_Ficha=(\d+))", 2).select(F.col("m.g2").alias("ficha"), F.lit(None).cast("string").alias("nombre"), "pos")
    return named.unionByName(bare).groupBy("ficha").agg(F.min_by("nombre", F.when(F.col("nombre").isNotNull(), F.col("pos"))).alias("nombre"))


def iachr_phases(df: DataFrame, html: str, ficha: str, country: str = "Colombia") -> DataFrame:
    """One seed per phase of the cases of a country; a series number takes the first phase that lists it."""
    rows = df.withColumn("t", text.strip_tags(F.col(html)))
    t, want = F.col("t"), text.fold(F.lit(country))
    defendant = text.fold(group(t, r"(?iu)Estado\s+[Dd]emandado\s*:?\s*([A-Za-zÁÉÍÓÚÑáéíóúñ .]+)", 1))
    rows = rows.where(F.when(defendant != "", defendant.startswith(want)).otherwise(text.fold(t).contains(want)))

    def listed(k: int, label: str, phase: str) -> Column:
        return F.transform(F.regexp_extract_all(t, F.lit(label + r"\s*:?\s*(\d{1,4})\b"), 1), lambda n: F.struct(F.lit(k).alias("k"), F.lit(phase).alias("fase"), n.alias("n")))

    found = F.concat(*[listed(k, label, phase) for k, (label, phase) in enumerate(IACHR_PHASES)])
    rows = rows.withColumn("_year", F.coalesce(group(t, r"[Ss]entencia\s+de\s+fondo\s+del?\s+\d{1,2}\s+de\s+\w+\s+de\s+(\d{4})", 1), group(t, r"\b(19\d{2}|20\d{2})\b", 1)))
    rows = rows.select("*", F.posexplode(found).alias("pos", "x"))
    rows = _first(rows.withColumn("_n", F.col("x.n")), ficha, "_n")
    year = F.when(F.col("x.fase") == "fondo", F.col("_year"))
    return _seeds(rows, tipo="SENTENCIA", numero=F.col("_n"), anio=year, source="corte_idh", corte="idh", _sala=F.col("x.fase"), external_id=F.concat(F.col(ficha).cast("string"), F.lit("-"), "_n"), source_url=F.concat(F.lit(IACHR + "/docs/casos/articulos/seriec_"), "_n", F.lit("_esp.pdf")), subtipo=F.col("x.fase"), extra=_extra(serie="C", pais=country))


def jep_items(df: DataFrame, mirrors: bool = False) -> DataFrame:
    """Seeds of API items (pos, nombre, tipo, year, numero, entidad, link); mirrored courts stay out.

    Of items with one link the first by ``pos`` counts.
    """
    blob = F.lower(F.concat_ws(" ", "tipo", "entidad"))
    rows = df.where(F.coalesce(F.trim("link"), F.lit("")) != "")
    rows = rows if mirrors else rows.where(~blob.rlike(JEP_MIRROR) & blob.rlike(JEP_ORIGIN))
    name = F.lower(F.concat_ws(" ", "nombre", "link"))
    auto = name.rlike(r"^\s*(auto|av |sv |svav)|_auto_|auto_| auto ")
    rules = [("sentencia|setencia", "SENTENCIA"), ("resoluci", "RESOLUCION"), ("acuerdo", "ACUERDO"), (r"^\s*ley|ley_", "LEY"), ("circular", "CIRCULAR"), (r"objeci|^\s*obj", "OBJECION"), ("documento|doc_", "DOCUMENTO")]
    kind = F.when(auto, F.when(name.contains("sentencia"), "SENTENCIA").otherwise("AUTO"))
    for pattern, tipo in rules:
        kind = kind.when(name.rlike(pattern), tipo)
    kind = kind.otherwise("AUTO")
    stem = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim("link"), r"(?i)\.html?$", ""), r"^(AV|SV|SVAV)_Dr[ae]?-[^_]+_", ""), r"(?i)^(Auto|Sentencia|Setencia|Resoluci[oó]n)_", "")
    number = F.coalesce(text.blank_to_null(F.col("numero")), F.nullif(F.regexp_replace(stem, r"^[_\-]+|[_\-]+$", ""), F.lit("")), F.trim("link"))
    rows = rows.withColumn("_l", F.trim("link"))
    return _seeds(_first(rows, "_l"), tipo=kind, numero=number, anio=_year_within(F.trim("year"), 1990, 2030), source="jep", corte=F.when(kind.isin("SENTENCIA", "AUTO"), "jep"), external_id=F.col("_l"), source_url=F.concat(F.lit(JEP_DOCS), "_l"), extra=_extra(entidad=F.col("entidad"), categoria=F.col("tipo"), titulo=F.col("nombre")))


def comptroller_index(df: DataFrame, html: str) -> DataFrame:
    """Seeds of document links of the comptroller's store: prefix, number without padding, year."""
    rows = _first(_each(df, html, COMPTROLLER_LINK, 1).withColumn("u", F.col("m.g1")), "u").where(F.col("u").rlike(COMPTROLLER_URL))
    prefix = F.replace(F.upper(F.regexp_extract("u", COMPTROLLER_URL, 2)), F.lit("%E2%80%93"), F.lit("-"))
    series = F.when(prefix.startswith("CGR"), "CGR-OJ").otherwise(prefix)
    padded, year = F.regexp_extract("u", COMPTROLLER_URL, 3), F.regexp_extract("u", COMPTROLLER_URL, 4)
    number = F.coalesce(F.nullif(F.regexp_replace(padded, "^0+", ""), F.lit("")), padded)
    return _seeds(rows, tipo=F.when(series == "CGR-OJ", "CONCEPTO").otherwise("RESOLUCION"), numero=number, anio=year, source="organos_control", external_id=F.concat_ws("-", series, padded, year), source_url=F.col("u"), extra=_extra(entidad="CONTRALORIA", serie=series))


#: Series of the comptroller's store to folder and prefix; widths of numbers and extensions in use there.
COMPTROLLER_SERIES = {"CONCEPTO": ("conceptos-juridicos", "CGR-OJ"), "RESOLUCION_REG": ("resoluciones", "REG-EJE"), "RESOLUCION_OGZ": ("resoluciones", "OGZ")}
COMPTROLLER_STORE = "https://relatoria.blob.core.windows.net/$web"
COMPTROLLER_WIDTHS, COMPTROLLER_EXTENSIONS, COMPTROLLER_MISSES = (3, 4), ("PDF", "pdf"), 12


def comptroller_candidates(df: DataFrame) -> DataFrame:
    """df (serie, numero, anio) with every address a number may have: its place ``intento`` in the order of trying, and ``url``."""
    ways = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(e).alias("e")) for w in COMPTROLLER_WIDTHS for e in COMPTROLLER_EXTENSIONS])
    folder, prefix = (text.lookup(F.col("serie"), {k: v[i] for k, v in COMPTROLLER_SERIES.items()}) for i in (0, 1))
    digits = F.col("numero").cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.col("x.w")), "0")
    rows = df.select("*", F.posexplode(ways).alias("intento", "x"))
    url = F.concat(F.lit(f"{COMPTROLLER_STORE}/files/"), folder, F.lit("/"), prefix, F.lit("-"), padded, F.lit("-"), F.col("anio").cast("string"), F.lit("."), F.col("x.e"))
    return rows.withColumn("url", url).drop("x")


def comptroller_found(candidates: DataFrame, answers: DataFrame, misses: int = COMPTROLLER_MISSES) -> DataFrame:
    """serie, numero, anio, url (null: none) of the numbers that a crawl gets to see.

    answers: url, status. A number is found at its first address that answers 200 or 206; a year's crawl
    goes on by number and ends with the ``misses``-th number in a row without one.
    """
    from ..operators.runs import until_misses

    good = answers.where(F.col("status").isin(200, 206)).select("url").distinct().withColumn("_good", F.lit(True))
    tried = candidates.join(good, "url", "left").groupBy("serie", "anio", "numero").agg(F.min_by("url", F.when(F.col("_good"), F.col("intento"))).alias("url"))
    return until_misses(tried, ["serie", "anio"], ["numero"], F.col("url").isNotNull(), misses).where("kept").select("serie", "numero", "anio", "url")


def docket_year(docket: Column, stamp: Column, latest: int) -> Column:
    """Year at digits 13 to 16 of a docket number, else the time stamp's."""
    digits = F.regexp_replace(docket, r"\D", "")
    return F.coalesce(F.when(F.length(digits) >= 16, _year_within(F.substring(digits, 13, 4), 1990, latest)), _year_within(F.substring(stamp, 1, 4), 1990, latest))


def discipline_results(df: DataFrame, payload: str, latest: int | None = None) -> DataFrame:
    """Seeds of rulings named in a search response, linked or bare; years after ``latest`` (next year) are none."""
    latest = latest or date.today().year + 1
    rows = _each(df, payload, DISCIPLINE_NAME, 2).withColumn("_f", F.concat("m.g1", F.lit("ADJUNTA"), "m.g2", F.lit(".pdf")))
    rows = _first(rows, "_f")
    url = F.concat(F.lit(DISCIPLINE_DOCS + "/"), "_f")
    return _seeds(rows, tipo="FALLO DISCIPLINARIO", numero=F.col("m.g1"), anio=docket_year(F.col("m.g1"), F.col("m.g2"), latest), source="organos_control", external_id=F.regexp_replace("_f", r"(?i)\.pdf$", ""), source_url=url, extra=_extra(entidad="CNDJ", radicado=F.col("m.g1"), timestamp=F.col("m.g2")))


def prosecutor_results(df: DataFrame, html: str) -> DataFrame:
    """Seeds of result links; type and year come from 600 characters on either side, but not from before the last link."""
    rows = _each(df, html, PROSECUTOR_LINK, 3).withColumn("u", F.col("m.g3"))
    rows = _first(rows.withColumn("u", F.when(F.col("u").startswith("http"), F.col("u")).otherwise(F.concat(F.lit("https://apps.procuraduria.gov.co"), "u"))), "u")
    around = text.strip_tags(F.concat(F.regexp_replace("m.g1", PROSECUTOR_PAGE, ""), F.col("m.g2")))
    docket = F.regexp_extract("u", r"([^/]+?)(?:\.[^/]*)?/*$", 1)
    kind = F.when(F.lower(F.regexp_extract(around, r"(?iu)\b(concepto|fallo|decisi[oó]n\s+disciplinaria|sentencia|auto)\b", 1)).isin("", "concepto"), "CONCEPTO").otherwise("FALLO DISCIPLINARIO")
    return _seeds(rows, tipo=kind, numero=docket, anio=group(around, r"\b((?:19|20)\d{2})\b", 1), source="organos_control", external_id=docket, source_url=F.col("u"), extra=_extra(entidad="PROCURADURIA", radicado=docket))


def _titled(c: Column, types: dict[str, str]) -> Column:
    low = text.collapse(F.lower(c))
    return F.coalesce(text.lookup(low, types), F.upper(low))


def bogota_records(df: DataFrame, html: str, ident: str, types: tuple[str, ...] = ("DECRETO", "ACUERDO", "RESOLUCION")) -> DataFrame:
    """Seeds of single records: title or heading, labelled fields; empty records and other types stay out."""
    page = F.col(html)
    title = F.coalesce(F.nullif(text.strip_tags(F.regexp_extract(page, "(?is)<title>(.*?)</title>", 1)), F.lit("")), F.nullif(text.strip_tags(F.regexp_extract(page, '(?is)<h2 class="h2">(.*?)</h2>', 1)), F.lit("")))
    rows = df.withColumn("_t", title).where(F.col("_t").rlike(BOGOTA_TITLE)).withColumn("_k", _titled(F.regexp_extract("_t", BOGOTA_TITLE, 1), BOGOTA_TYPES)).where(F.col("_k").isin(*types))
    field = lambda label: F.nullif(text.strip_tags(F.regexp_extract(page, rf'(?is){label}[^<]*</div>\s*<div class="col-lg-12">\s*(.*?)\s*</div>', 1)), F.lit(""))
    extra = _extra(ambito="Distrital", entidad_emisora=group(F.col("_t"), BOGOTA_TITLE, 4), fecha_expedicion=field("Fecha de Expedici"), fecha_vigencia=field("Fecha de Entrada en Vigencia"), medio_publicacion=field("Medio de Publicaci"))
    return _seeds(rows, tipo=F.col("_k"), numero=F.regexp_extract("_t", BOGOTA_TITLE, 2), anio=F.regexp_extract("_t", BOGOTA_TITLE, 3), source="regimen_bogota", external_id=F.col(ident).cast("string"), source_url=F.concat(F.lit(BOGOTA), F.col(ident).cast("string")), extra=extra)


def bogota_index(df: DataFrame, html: str, types: tuple[str, ...] = ("DECRETO", "ACUERDO", "RESOLUCION")) -> DataFrame:
    """Seeds of a result page's links, each id once."""
    rows = _first(_each(df, html, r'(?is)<a[^>]+href="[^"]*Norma1\.jsp\?i=(\d+)"[^>]*>(.*?)</a>', 2).withColumn("_i", F.col("m.g1")), "_i").withColumn("_t", text.strip_tags(F.col("m.g2"))).where(F.col("_t").rlike(BOGOTA_TITLE))
    rows = rows.withColumn("_k", _titled(F.regexp_extract("_t", BOGOTA_TITLE, 1), BOGOTA_TYPES)).where(F.col("_k").isin(*types))
    return _seeds(rows, tipo=F.col("_k"), numero=F.regexp_extract("_t", BOGOTA_TITLE, 2), anio=F.regexp_extract("_t", BOGOTA_TITLE, 3), source="regimen_bogota", external_id=F.col("_i"), source_url=F.concat(F.lit(BOGOTA), "_i"), extra=_extra(ambito="Distrital"))


def bank_index(df: DataFrame, html: str) -> DataFrame:
    """Seeds of the central bank's index: external resolutions, regulatory circulars, else the bulletin."""
    rows = _each(df, html, BANK_CELL, 1).withColumn("_c", F.col("m.g1"))
    rows = rows.withColumn("_p", group(F.col("_c"), r'(?is)<a\s+href="([^"]*reglamentacion/archivos/[^"]+\.pdf)"', 1)).where("_p IS NOT NULL")
    rows = rows.withColumn("_t", text.strip_tags(F.regexp_extract("_c", r'(?is)<a\s+href="[^"]+"[^>]*hreflang="[^"]*"[^>]*>(.*?)</a>', 1)))
    t, res = F.col("_t"), r"(?iu)resoluci[oó]n\s+externa\s+(?:n[ouº°.\s]*)?(\d+)\s+de\s+(\d{4})"
    cir, bulletin = r"(?iu)circular\s+reglamentaria\s+externa\s+([a-z]{2,5})[\s\-]*([0-9a-z\-]+)", r"(?i)bjd_([0-9a-z\-]+)_(\d{4})\.pdf$"
    by_res, by_cir, b_num, b_year = t.rlike(res), t.rlike(cir), group(F.col("_p"), bulletin, 1), group(F.col("_p"), bulletin, 2)
    tipo = F.when(by_res, "RESOLUCION").when(by_cir | b_num.isNotNull(), "CIRCULAR")
    numero = F.coalesce(F.when(by_res, group(t, res, 1)).when(by_cir, F.upper(group(t, cir, 2))), b_num)
    anio = F.coalesce(F.when(by_res, group(t, res, 2)).when(by_cir, group(t, r"(?i)\bde\s+(\d{4})\b", 1)), b_year)
    kind = F.when(by_res, "RESOLUCION EXTERNA").when(by_cir, "CIRCULAR REGLAMENTARIA EXTERNA").otherwise("BOLETIN JUNTA DIRECTIVA")
    rows = rows.withColumns({"_k": tipo, "_n": numero, "_y": _year_within(anio, 1900, 2030)}).where("_k IS NOT NULL AND _n IS NOT NULL AND _y IS NOT NULL")
    url = F.when(F.col("_p").startswith("http"), F.col("_p")).otherwise(F.concat(F.lit(BANK + "/"), F.regexp_replace("_p", "^/+", "")))
    return _seeds(rows, tipo=F.col("_k"), numero=F.col("_n"), anio=F.col("_y"), source="banco_republica", source_url=url, subtipo=kind, extra=_extra(entidad="BANCO DE LA REPUBLICA", titulo=t))


def eva_index(df: DataFrame, html: str) -> DataFrame:
    """Seeds of a normative index, each id once; titles that do not parse give a bare seed."""
    rows = _each(df, html, r"(?is)<a\b[^>]*\bhref=[\"']?[^\"'>]*norma\.php\?i=(\d+)[^>]*>(.*?)</a>", 2).withColumn("_i", F.col("m.g1")).withColumn("_t", text.strip_tags(F.col("m.g2"))).where("_t <> ''")
    t = F.col("_t")
    number = group(t, EVA_TEXT, 2)
    tipo = F.when(number.isNull(), "NORMA").otherwise(_titled(F.regexp_extract(t, EVA_TEXT, 1), EVA_TYPES))
    return _seeds(_first(rows, "_i"), tipo=tipo, numero=F.coalesce(number, F.lit("")), anio=_year_within(group(t, EVA_TEXT, 3), 1810, 2035), source="funcion_publica", external_id=F.col("_i"), source_url=F.concat(F.lit(EVA_PDF), "_i"), extra=_extra(entidad="FUNCION_PUBLICA", titulo=t))


def can_listing(df: DataFrame, html: str, tribunal: bool = True, base: str = "https://www.comunidadandina.org") -> DataFrame:
    """Seeds of decisions and, if wanted, tribunal cases, each once."""
    decisions = _each(df, html, r"(?is)href=[\"']([^\"']*DocOficialesFiles/decisiones/DECISION(\d+)\.pdf)[\"'][^>]*>(.*?)</a>", 3).withColumn("_n", F.col("m.g2")).withColumn("_t", text.strip_tags(F.col("m.g3")))
    absolute = F.when(F.col("m.g1").startswith("http"), F.col("m.g1")).otherwise(F.concat(F.lit(base), F.when(F.col("m.g1").startswith("/"), F.col("m.g1")).otherwise(F.concat(F.lit("/"), F.col("m.g1")))))
    out = _seeds(_first(decisions, "_n"), tipo="DECISION CAN", numero=F.col("_n"), anio=group(F.col("_t"), r"\b(19\d{2}|20\d{2})\b", 1), source="can", corte="can", external_id=F.col("_n"), source_url=absolute, extra=_extra(organismo="Comunidad Andina", titulo=F.nullif(F.col("_t"), F.lit(""))))
    if not tribunal:
        return out
    cases = _each(df, html, r"(?i)href=[\"']([^\"']*DocOficialesFiles/Procesos/([^\"'./]+)\.pdf)[\"']", 2).withColumn("_n", F.col("m.g2"))
    return out.unionByName(_seeds(_first(cases, "_n"), tipo="SENTENCIA", numero=F.col("_n"), source="can", corte="can", external_id=F.col("_n"), source_url=absolute, extra=_extra(organismo="Tribunal de Justicia CAN")))


def patterned_decisions(first: int, last: int, listed: DataFrame, base: str = "https://www.comunidadandina.org") -> DataFrame:
    """Listed seeds and, for numbers of the range that no listing has, seeds by the address pattern."""
    numbers = listed.sparkSession.range(first, last + 1).select(F.col("id").cast("string").alias("_n"))
    missing = numbers.join(listed.where("tipo = 'DECISION CAN'").select(F.col("numero").alias("_n")), "_n", "left_anti")
    made = _seeds(missing, tipo="DECISION CAN", numero=F.col("_n"), source="can", corte="can", external_id=F.col("_n"), source_url=F.concat(F.lit(base + "/DocOficialesFiles/decisiones/DECISION"), "_n", F.lit(".pdf")))
    return listed.unionByName(made)


def cne_year_page(df: DataFrame, html: str) -> DataFrame:
    """Seeds of a year page: link text, else the decoded file name; each (type, number, year) once."""
    rows = _each(df, html, LINK, 2).where(~F.lower(F.trim("m.g1")).rlike("^#|^javascript:"))
    shown, name = text.strip_tags(F.col("m.g2")), F.try_url_decode(F.col("m.g1"))
    by_text = shown.rlike(CNE_TEXT)
    tipo = F.when(by_text, F.upper(text.strip_accents(F.regexp_extract(shown, CNE_TEXT, 1)))).otherwise("RESOLUCION")
    numero = F.when(by_text, group(shown, CNE_TEXT, 2)).otherwise(group(name, CNE_FILE, 1))
    anio = F.when(by_text, group(shown, CNE_TEXT, 3)).otherwise(group(name, CNE_FILE, 2))
    rows = rows.withColumns({"_k": tipo, "_n": numero, "_y": _year_within(anio, 1990, 2035)}).where("_n IS NOT NULL AND _y IS NOT NULL")
    rows = _first(rows, "_k", "_n", "_y")
    return _seeds(rows, tipo=F.col("_k"), numero=F.col("_n"), anio=F.col("_y"), source="cne", corte="cne", _sala=F.when(F.col("_k") == "RESOLUCION", "plena"), external_id=F.concat_ws("-", "_n", "_y"), source_url=F.col("m.g1"), extra=_extra(entidad="CNE", titulo=F.nullif(shown, F.lit(""))))


def gazette_rows(df: DataFrame, html: str) -> DataFrame:
    """Editions of the official gazette: row keys and labels; thousands dots go; editions are no norms."""
    rows = _each(df, html, r'(?is)<tr\b[^>]*\bdata-rk="([^"]+)"[^>]*>(.*?)</tr>', 2)
    label = lambda name: F.nullif(text.strip_tags(F.regexp_extract("m.g2", rf'(?is)<label[^>]*id="[^"]*:{name}"[^>]*>(.*?)</label>', 1)), F.lit(""))
    shown, day = F.coalesce(label("numeroDiario"), F.col("m.g1")), label("fechaDiario")
    rows = rows.withColumn("_n", F.regexp_replace(shown, r"[.\s]", "")).where(F.col("_n").rlike(r"^\d+$"))
    iso = F.regexp_replace(F.regexp_extract(day, r"(\d{2}/\d{2}/\d{4})", 1), r"(\d{2})/(\d{2})/(\d{4})", "$3-$2-$1")
    return _seeds(rows, cid=False, tipo="DIARIO OFICIAL", numero=F.col("_n"), anio=group(day, r"\d{2}/\d{2}/(\d{4})", 1), source="diario_oficial", external_id=F.col("_n"), source_url="https://svrpubindc.imprenta.gov.co/diario/view/diarioficial/detallesPdf.xhtml", extra=_extra(edicion=F.trim(shown), fecha=F.nullif(iso, F.lit("")), tipo_edicion=F.upper(label("tipoEdicion"))))


def congress_gazettes(df: DataFrame, html: str) -> DataFrame:
    """Seeds of (chamber, date, number) links, each triple once."""
    rows = _each(df, html, r"(?i)index2\.xhtml\?ent=(Senado|Camara)&(?:amp;)?fec=(\d{1,2}-\d{1,2}-\d{4})&(?:amp;)?num=(\d+)", 3).select("*", F.initcap("m.g1").alias("_e"), F.col("m.g2").alias("_d"), F.col("m.g3").alias("_n"))
    url = F.concat(F.lit(GAZETTE + "?ent="), "_e", F.lit("&fec="), "_d", F.lit("&num="), "_n")
    return _seeds(_first(rows, "_e", "_n", "_d"), cid=False, tipo="GACETA", numero=F.col("_n"), anio=group(F.col("_d"), r"-(\d{4})$", 1), source="gaceta_congreso", external_id=F.col("_n"), source_url=url, extra=_extra(entidad=F.upper("_e"), fecha=F.col("_d"), ambito="Nacional"))


def finance_publications(df: DataFrame, html: str) -> DataFrame:
    """Seeds of the financial supervisor's listing, each publication once."""
    rows = _each(df, html, r'(?is)<a[^>]+href="([^"]*loadContenidoPublicacion[^"]*id=(\d+)[^"]*)"[^>]*>(.*?)</a>', 3).withColumn("_t", text.strip_tags(F.col("m.g3"))).withColumn("_i", F.col("m.g2"))
    return _supervised(_first(rows.where(F.col("_t").rlike(SUPERVISOR_TEXT)), "_i"), "SUPERFINANCIERA", F.concat(F.lit(FINANCE_LOADER), "_i"), F.col("_i"))


def commerce_publications(df: DataFrame, html: str, base: str = "https://www.sic.gov.co") -> DataFrame:
    """Seeds of the commerce supervisor's repository, each (number, year) once."""
    rows = _each(df, html, LINK, 2).withColumn("_t", text.strip_tags(F.col("m.g2"))).where(F.col("_t").rlike(SUPERVISOR_TEXT))
    rows = _first(rows.withColumn("_n", F.regexp_extract("_t", SUPERVISOR_TEXT, 2)).withColumn("_y", F.regexp_extract("_t", SUPERVISOR_TEXT, 3)), "_n", "_y")
    return _supervised(rows, "SIC", F.when(F.col("m.g1").startswith("http"), F.col("m.g1")).otherwise(F.concat(F.lit(base), F.col("m.g1"))), F.lit(None).cast("string"))


def _supervised(rows: DataFrame, entity: str, url: Column, ident: Column) -> DataFrame:
    t = F.col("_t")
    return _seeds(rows, tipo=_titled(F.regexp_extract(t, SUPERVISOR_TEXT, 1), SUPERVISOR_TYPES), numero=F.regexp_extract(t, SUPERVISOR_TEXT, 2), anio=F.regexp_extract(t, SUPERVISOR_TEXT, 3), source="superintendencias", external_id=ident, source_url=url, extra=_extra(entidad=entity, ambito="Nacional"))


def court_dataset(df: DataFrame) -> DataFrame:
    """Seeds of the constitutional court's open data (sentencia, sentencia_tipo, magistrado_a, sala, fecha_sentencia)."""
    ruling, day = F.trim("sentencia"), F.coalesce(F.trim("fecha_sentencia"), F.lit(""))
    short = F.regexp_extract(ruling, r"/\s*(\d{2})", 1)
    year = F.coalesce(group(day, r"^(\d{4})", 1), F.when(short != "", F.concat(F.when(short >= "90", "19").otherwise("20"), short)))
    number = F.trim(F.element_at(F.split(ruling, "/"), 1))
    chamber = F.coalesce(text.lookup(F.lower(F.trim("sala")), COURT_CHAMBERS), F.when(F.upper(F.trim("sentencia_tipo")).isin("C", "SU"), "plena").otherwise("revision"))
    ident = F.concat(number, F.lit("-"), F.substring(year, 3, 2))
    url = F.concat(F.lit("https://www.corteconstitucional.gov.co/relatoria/"), year, F.lit("/"), ident, F.lit(".htm"))
    return _seeds(df, tipo="SENTENCIA", numero=number, anio=year, source="corte_constitucional", corte="cc", _sala=chamber, magistrado_ponente=F.col("magistrado_a"), external_id=ident, source_url=url, subtipo=F.upper(F.trim("sentencia_tipo")))


def treaty_dataset(df: DataFrame) -> DataFrame:
    """Seeds of the treaty open data: slug as number, year of adoption, approving law and control ruling kept."""
    name = F.trim("nombretratado")
    notes = F.array_join(F.array_compact(F.array(F.concat(F.lit("Ley aprobatoria: "), text.blank_to_null(F.col("numeroleyaprobatoria"))), F.concat(F.lit("Control constitucional: "), text.blank_to_null(F.col("sentencianumero"))))), "; ")
    matter = F.when(notes != "", F.concat(name, F.lit(" — "), notes)).otherwise(name)
    state = F.when(F.upper(F.trim("vigente")) == "SI", "Vigente").when(F.trim("vigente") != "", "No vigente")
    return _seeds(df, tipo="TRATADO", numero=F.nullif(text.slug(name), F.lit("")), anio=group(F.col("fechaadopcion"), r"(\d{4})", 1), source="tratados", extra=_extra(materia=matter, vigencia=state, entidad="Ministerio de Relaciones Exteriores"))


#: Source key to its page parser; sources without one are named in ``connector``'s error.
PARSERS: dict[str, Callable[..., DataFrame]] = {
    "corte_idh": iachr_phases,
    "jep": jep_items,
    "organos_control": comptroller_index,
    "regimen_bogota": bogota_records,
    "banco_republica": bank_index,
    "funcion_publica": eva_index,
    "can": can_listing,
    "cne": cne_year_page,
    "diario_oficial": gazette_rows,
    "gaceta_congreso": congress_gazettes,
    "superintendencias": commerce_publications,
    "corte_constitucional": court_dataset,
    "tratados": treaty_dataset,
    "csj": ruling_rows,
    "consejo_estado": ruling_rows,
    "creg": normogram_links,
    "crc": normogram_links,
    "cra": normogram_links,
    "dian": normogram_items,
}


def connector(source: str) -> Callable[..., DataFrame]:
    """The parser of a source; unknown sources raise ValueError."""
    if source not in PARSERS:
        raise ValueError(f"no connector for source {source!r}; known: {', '.join(sorted(PARSERS))}")
    return PARSERS[source]
