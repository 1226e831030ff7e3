"""Text functions, identifiers, chunk splitting and sections against plain Python."""

import re
import unicodedata
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import ids, text, vocab
from lexmill.operators import affectations, chunking, citations, orders, sections
from lexmill.sources import html

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, make):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r[1] for r in rows.select("i", make(F.col("s"))).orderBy("i").collect()]


def fold(s):
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z0-9 ]", " ", s)).strip().lower()


@SLOW
@given(st.lists(st.text(alphabet="aÁeéñÑüÇx  .-9́", max_size=30), min_size=1, max_size=20))
def test_fold(spark, values):
    assert column(spark, values, text.fold) == [fold(v) for v in values]


def test_repair_and_title(spark):
    assert column(spark, ["CrÃ©dito", "Crédito", "Ãx", "日Ã"], text.repair_text) == ["Crédito", "Crédito", "Ãx", "日Ã"]
    assert column(spark, ["MINISTERIO DE HACIENDA", "dian", "Ya Mixto", ""], text.title_case) == ["Ministerio de Hacienda", "DIAN", "Ya Mixto", ""]


def test_article_numbers(spark):
    given_ = ["Artículo 5°.", "ARTÍCULO 5A.", "artículo transitorio 1", "Artículo 3o. Objeto", "Parágrafo", None]
    assert column(spark, given_, text.article_number) == ["5", "5a", "trans:1", "3", None, None]


def test_dates(spark):
    found = column(spark, ["Vigente desde: 03/10/2007 y hasta el: 05/01/2011", "31/02/2010", "1/2/2003", None], text.date_range)
    assert [tuple(str(x) if x else None for x in r) for r in found] == [("2007-10-03", "2011-01-05"), (None, None), ("2003-02-01", None), (None, None)]
    assert [str(d) for d in column(spark, ["2010-05-06", "el 7/8/2009", "x"], text.any_date)] == ["2010-05-06", "2009-08-07", "None"]


def test_ids(spark):
    cid = ids.canonical_id(F.lit("ACTO LEGISLATIVO"), F.lit("01"), F.lit("2003"), art=F.lit("5A"), par=F.lit("2"))
    assert column(spark, ["x"], lambda _: cid) == ["co:acto_legislativo:01:2003:art:5a:par:2"]
    half = ids.canonical_id(F.lit("SENTENCIA"), F.lit("C-1"), F.lit("2000"), corte=F.lit("cc"))
    assert column(spark, ["x"], lambda _: half) == ["co:sentencia:c-1:2000"]
    names = ["co:ley:1:2000", "ñ"]
    want = [str(uuid.uuid5(uuid.UUID(vocab.CHUNK_NAMESPACE), f"{n}#chunk3")) for n in names]
    assert column(spark, names, lambda c: ids.chunk_uid(c, F.lit(3))) == want


def test_affectations(spark):
    raw = ["Derogado  parcialmente", "derogado parcialmente (x)", "  DECLARADO EXEQUIBLE  nota", "citado", ""]
    assert [r["tipo"] for r in column(spark, raw, affectations.normalised)] == ["DEROGA_PARCIAL", "DEROGA_TOTAL", "EXEQUIBLE", "UNKNOWN", "UNKNOWN"]
    assert column(spark, ["derogado parcialmente (x)"], lambda c: affectations.normalised(c, longest=True))[0]["tipo"] == "DEROGA_PARCIAL"


def sentences(s):
    return [x.strip() for x in re.split(vocab.SENTENCE_END, s) if x.strip()]


def brute_split(s, most, overlap):
    s = s.strip()
    if not s or len(s) <= most:
        return [s] if s else []
    out, buf, size = [], [], 0
    for block in [b.strip() for b in re.split(r"\n\s*\n", s) if b.strip()]:
        if len(block) > most or (buf and size + 2 + len(block) > most):
            out += ["\n\n".join(buf)] if buf else []
            buf, size = [], 0
        if len(block) <= most:
            buf.append(block)
            size += len(block) + 2
            continue
        line = ""
        for x in sentences(block):
            if len(x) > most:
                out += [line] if line else []
                line = ""
                out += [p for p in (x[i : i + most].strip() for i in range(0, len(x), most)) if p]
            elif line and len(line) + 1 + len(x) > most:
                out.append(line)
                line = x
            else:
                line = f"{line} {x}".strip()
        out += [line] if line else []
    out += ["\n\n".join(buf)] if buf else []
    tails = [None] + [(sentences(p) or [""])[-1] for p in out[:-1]]
    return [f"{t}\n\n{p}" if t and len(t) <= overlap else p for t, p in zip(tails, out)]


@SLOW
@given(st.lists(st.lists(st.sampled_from(["Uno dos.", "Tres! Cuatro cinco seis.", "\n\n", "x" * 50, " ", "Ñandú corre?", "fin"]), max_size=25).map(" ".join), min_size=1, max_size=15))
def test_split_text(spark, values):
    assert column(spark, values, lambda c: chunking.split_text(c, 40, 12)) == [brute_split(v, 40, 12) for v in values]


def test_sections(spark):
    md = "M.P. Fulano\n# I. ANTECEDENTES\nhechos\n## 1. Lo demás\nalgo\n### a) Detalle\n# VIII. **DECISIÓN**\nResuelve\n## Otra"
    rows = spark.createDataFrame([(1, md), (2, None), (3, " \n ")], "d int, md string")
    got = [tuple(r)[1:] for r in sections.split_sections(rows, "d", "md").orderBy("seq").collect()]
    assert [(r[0], r[1], r[3], r[5]) for r in got] == [(0, 0, "ENCABEZADO", None), (1, 1, "ANTECEDENTES", None), (2, 2, "ANTECEDENTES", 1), (3, 3, "ANTECEDENTES", 2), (4, 1, "PARTE_RESOLUTIVA", None), (5, 2, "PARTE_RESOLUTIVA", 4)]


def test_orders_and_citations(spark):
    body = "Antes\nPRIMERO.- Declarar EXEQUIBLE, en el entendido que vale, el artículo 5 de la Ley 10 de 1990.\nSéptimo: REVOCAR\n12) Nada"
    rows = orders.split_orders(spark.createDataFrame([(1, body), (2, None)], "d int, r string"), ["d"], "r").orderBy("pos").collect()
    assert [(r.order_number, r.decision_type) for r in rows] == [(1, "EXEQUIBLE_CONDICIONADA"), (7, "REVOCA"), (12, "OTRO")]
    assert rows[0].targets[0].articulo == "5" and rows[0].targets[0].numero == "10"
    assert len(orders.split_orders(spark.createDataFrame([(1, body)], "d int, r string"), ["d"], "r", plain=True).collect()) == 2
    found = citations.find_citations("artículo 5 de la Ley 10 de 1990 y la ley 10 de 1990; Decreto Ley 7 de 1991; sentencia su-62 de 2019")
    assert [(c[0], c[2], c[4]) for c in found] == [("ley", "10", "5"), ("ley", "10", None), ("decreto", "7", None), ("sentencia", "SU-62", None)]
    assert citations.find_citations(None) == []


def plain_citations(text):
    """Every family's pattern over the whole text, spans kept in a list."""
    taken, out = [], {}
    for kind, pattern, groups in vocab.CITATION_FAMILIES:
        for m in re.finditer(pattern, text, re.IGNORECASE):
            if any(m.start() < end and m.end() > start for start, end in taken):
                continue
            taken.append(m.span())
            found = dict(zip(groups, m.groups()))
            number = f"{found['prefijo'].upper()}-{found['numero']}" if "prefijo" in found else found.get("numero")
            name = found["nombre"].strip().lower() if "nombre" in found else None
            out.setdefault((kind, number, found.get("anio"), found.get("articulo"), name), m.group(0))
    return [(k[0], raw, *k[1:]) for k, raw in out.items()]


PIECES = ["artículo 5 ", "ARTICULO 29 ", "de la ", "del ", "Ley 10 de 1990", "ley 7 de 2001", "Decreto ", "decreto ley 3 de 1999", " Sentencia C-1 de 2000", "ſentencia T-2 de 2001", "resolución 8 de 1988 ", "acto legislativo 1 de 2003", "Constitución", "código civil", "Código  de procedimiento penal ", "x", " ", "\n", "ley", "artículo 5 de la ley 7 de 2001 "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_citations_by_cue(text):
    assert citations.find_citations(text) == plain_citations(text)


PAGE = """<body class="documento_cms"><span field="tipo">LEY</span><span field="numero">7</span><span field="anio">2001</span><span field="x">NULL</span>
<div id="9cuerpo-toc"><li class="vinieta-toc"><a href="#ver_1"></a><span class="toctextart">Art 1</span></li></div>
<div id="9ResumenNotasVigencia"><ul class="resumenvigencias"><li class="resumenvigencias"><b>Artículo 1:</b><ul><li class="referencia"><span>Derogado</span> <a href="v.asp?id=55#ver_8">Ley 9 de 2002</a> (art 2)</li></ul></li></ul></div>
<a name="ver_1"></a><div id="toggle_1"><p><strong>Artículo 1°.</strong><em>Objeto.</em></p><p>Texto [Mostrar]</p></div><div id="9NotasDestino1"><li class="referencia">nota</li></div>
<div id="div1leg_ant"><div style="background-color: #E0E0E0"><font color="#336600">Hasta 01/02/2003</font><p>viejo</p></div></div>
<a name="ver_2"></a><div id="toggle_2"><p><strong>Artículo 1</strong> repetido</p></div><div id="9NotasOrigen2"><li class="referencia"><span>Modifica</span><a href="id=3">Decreto 4 de 1999</a></li></div></body>"""


def test_norm_page(spark):
    row = html.parse_norms(spark.createDataFrame([("9", PAGE), ("8", None)], "suin_id string, html string")).orderBy(F.desc("suin_id")).collect()
    norm = row[0]
    assert norm.metadata == {"tipo": "LEY", "numero": "7", "anio": "2001"} and norm.toc[0].level == "articulo"
    assert norm.modifications[0].normalized_type == "DEROGA_TOTAL" and norm.modifications[0].source_suin_id == "55" and norm.modifications[0].context == "(art 2)"
    art = norm.articles[0]
    assert len(norm.articles) == 1 and art.canonical_id == "co:ley:7:2001:art:1" and art.title == "Objeto" and "Mostrar" not in art.text
    assert art.notes == ["nota"] and art.previous_versions[0].text == "viejo" and art.affects[0].target_text == "Decreto 4 de 1999"
    assert row[1].articles == [] and row[1].parse_error is None


def plain_sections(md):
    """Line by line, with a stack of open headings."""
    import re

    out, body, head = [], [], (0, "")
    lines = re.split(r"\r?\n", re.sub(r"^\s+|\s+$", "", md or "", flags=re.A))
    for line in [*lines, None]:
        m = None if line is None else re.match(sections.HEADING, line)
        if line is None or m:
            text = re.sub(r"^\s+|\s+$", "", "\n".join(body), flags=re.A)
            if head[0] or text:
                out.append((len(out), *head, text))
            body, head = [], (len(m[1]), m[2].strip(" ")) if m else None
        else:
            body.append(line)
    rows, path = [], []
    for seq, level, heading, text in out:
        path = [x for x in path if x[1] < level]
        own = "ENCABEZADO" if not level else "DEMANDA" if "demanda" in heading.lower() else "COMPETENCIA" if "ompetencia" in heading else path[-1][2] if path else "OTRO"
        rows.append((seq, level, heading, own, text, path[-1][0] if path else None))
        path += [(seq, level, own)] if level else []
    return rows


def test_sections_in_their_row(spark):
    """Any order of headings, as a plain reading has it; a ruling's sections and orders need no exchange."""
    import random

    from lexmill.operators import rulings

    rng = random.Random(3)
    pieces = ["# Demanda", "## 1. Competencia", "### Algo", "#### a) Más", "###### Hondo", "#sin", "texto", "", "  ", "\tdos # tres", "## **La demanda**"]
    texts = [rng.choice(["\n", "\r\n"]).join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(150)] + [None, " \n ", "# Demanda"]
    rows = spark.createDataFrame(list(enumerate(texts)), "d int, md string")
    got: dict = {}
    for r in sections.split_sections(rows, "d", "md").collect():
        got.setdefault(r.d, []).append(tuple(r)[1:])
    for d, md in enumerate(texts):
        assert sorted(got.get(d, [])) == plain_sections(md), md
    docs = rows.selectExpr("cast(d as string) AS suin_id", "md", *[f"cast(null as string) AS {c}" for c in ("tipo", "numero", "anio", "corte", "magistrado_ponente")])
    plan = rulings.map_rulings(docs)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString() and plan.count() == len(texts)
