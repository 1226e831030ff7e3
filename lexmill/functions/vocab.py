"""Closed vocabularies of the legal domain.

Fixed values: names, spellings and orders below are data that results depend on.
"""

from __future__ import annotations

# --- fixed values: document types -------------------------------------------------------------
DOCUMENT_TYPES = {
    "LEY": "ley",
    "DECRETO": "decreto",
    "ACTO LEGISLATIVO": "acto_legislativo",
    "RESOLUCION": "resolucion",
    "CIRCULAR EXTERNA": "circular_externa",
    "DIRECTIVA PRESIDENCIAL": "directiva_presidencial",
    "CONSTITUCION POLITICA": "constitucion",
    "CODIGO": "codigo",
    "CIRCULAR": "circular",
    "ACUERDO": "acuerdo",
    "INSTRUCCION ADMINISTRATIVA CONJUNTA": "instruccion_admin",
    "RESOLUCION EXTERNA": "resolucion_externa",
    "CIRCULAR CONJUNTA": "circular_conjunta",
    "INSTRUCCION": "instruccion",
    "DIRECTIVA VICEPRESIDENCIAL": "directiva_vicepresidencial",
    "DIRECTIVA MINISTERIAL": "directiva_ministerial",
    "CIRCULAR VICEPRESIDENCIAL": "circular_vicepresidencial",
    "CARTA CIRCULAR": "carta_circular",
    "CONCEPTO": "concepto",
    "TRATADO": "tratado",
    "DECISION CAN": "decision_can",
    "FALLO DISCIPLINARIO": "fallo_disciplinario",
    "OPINION CONSULTIVA": "opinion_consultiva",
    "AUTO": "auto",
    "PROYECTO DE LEY": "proyecto_ley",
    "EXPOSICION DE MOTIVOS": "exposicion_motivos",
}

# --- fixed values: affectations, raw forms in order of precedence -------------------------------
AFFECTATIONS = {
    "modificado": "MODIFICA",
    "modificado parcialmente": "MODIFICA",
    "modifica": "MODIFICA",
    "derogado": "DEROGA_TOTAL",
    "deroga": "DEROGA_TOTAL",
    "derogado totalmente": "DEROGA_TOTAL",
    "derogado tácitamente": "DEROGA_TOTAL",
    "derogado parcialmente": "DEROGA_PARCIAL",
    "deroga parcialmente": "DEROGA_PARCIAL",
    "adicionado": "ADICIONA",
    "adiciona": "ADICIONA",
    "corregido yerro": "CORRIGE_YERRO",
    "corrección de yerro": "CORRIGE_YERRO",
    "declarado exequible": "EXEQUIBLE",
    "exequible": "EXEQUIBLE",
    "declarado inexequible": "INEXEQUIBLE",
    "inexequible": "INEXEQUIBLE",
    "declarado condicionalmente exequible": "EXEQUIBLE_CONDICIONADA",
    "exequible condicionado": "EXEQUIBLE_CONDICIONADA",
    "exequible condicionada": "EXEQUIBLE_CONDICIONADA",
    "condicionalmente exequible": "EXEQUIBLE_CONDICIONADA",
    "reglamentado": "REGLAMENTA",
    "reglamentado parcialmente": "REGLAMENTA",
    "reglamenta": "REGLAMENTA",
    "compilado": "COMPILA",
    "compila": "COMPILA",
    "sustituido": "SUSTITUYE",
    "sustituye": "SUSTITUYE",
    "suspendido": "SUSPENDE",
    "suspende": "SUSPENDE",
    "prorrogado": "PRORROGA",
    "prorroga": "PRORROGA",
    "aclarado": "ACLARA",
    "aclara": "ACLARA",
    "complementa": "COMPLEMENTA",
    "complementado": "COMPLEMENTA",
    "interpreta": "INTERPRETA",
    "interpretado": "INTERPRETA",
}
UNKNOWN_AFFECTATION = "UNKNOWN"
#: Types that change a text and leave it in force: for chunk flags, and for reports.
CHUNK_MODIFYING = ["MODIFICA", "ADICIONA", "SUSTITUYE", "CORRIGE_YERRO", "COMPLEMENTA"]
REPORT_MODIFYING = ["MODIFICA", "ADICIONA", "SUSTITUYE", "CORRIGE_YERRO", "DEROGA_PARCIAL", "COMPLEMENTA"]
WHOLE_DOCUMENT = ["documento completo", "toda la norma", "la norma", "todo el documento"]

# --- fixed values: ruling sections, first match wins ---------------------------------------------
SECTION_RULES = [
    ("SALVAMENTO_DE_VOTO", r"salvamento\s+(?:parcial\s+)?de\s+voto"),
    ("ACLARACION_DE_VOTO", r"aclaraci[oó]n\s+(?:parcial\s+)?de\s+voto"),
    ("PARTE_RESOLUTIVA", r"\b(decisi[oó]n|resuelve|resoluci[oó]n|falla|fallo|parte\s+resolutiva)\b"),
    ("CONCEPTO_PROCURADURIA", r"concepto\b.*procurad|ministerio\s+p[uú]blico|vista\s+fiscal|procurador"),
    ("NORMA_DEMANDADA", r"texto\b.*norma|norma[s]?\s+demandad|disposici[oó]n[es]*\s+demandad|texto\s+legal"),
    ("INTERVENCIONES", r"intervenci[oó]n|intervinient"),
    ("DEMANDA", r"\b(la\s+demanda|demanda\b|pretensiones|cargos\s+de\s+la\s+demanda)\b"),
    ("ANTECEDENTES", r"antecedent|hechos\b|s[ií]ntesis\s+de\s+los\s+hechos"),
    ("PROBLEMA_JURIDICO", r"problema[s]?\s+jur[ií]dico|cuesti[oó]n\s+a\s+resolver|asunto\s+bajo\s+revisi[oó]n"),
    ("COMPETENCIA", r"\bcompetencia\b"),
    ("CUESTION_PREVIA", r"cuesti[oó]n\s+previa|aptitud\s+de\s+la\s+demanda|aptitud\s+sustantiva|asunto[s]?\s+preliminar"),
    ("CASO_CONCRETO", r"caso\s+concreto|an[aá]lisis\s+del\s+caso|soluci[oó]n\s+del\s+caso"),
    ("MARCO_NORMATIVO", r"marco\s+(?:normativo|jur[ií]dico|constitucional)|precedente|reiteraci[oó]n\s+de\s+jurisprudencia|fundamento[s]?\s+normativo"),
    ("ANALISIS", r"an[aá]lisis|examen|estudio\b|consideraci[oó]n\s+de\s+la\s+(?:sala|corte)"),
    ("CONSIDERACIONES", r"consideraci[oó]n|fundamento"),
    ("FIRMAS", r"\bfirma[s]?\b|notif[ií]quese"),
]
PREAMBLE, OTHER_SECTION = "ENCABEZADO", "OTRO"
FACTS_SECTIONS = ["ANTECEDENTES", "DEMANDA", "NORMA_DEMANDADA", "INTERVENCIONES", "CONCEPTO_PROCURADURIA"]
REASONING_SECTIONS = ["CONSIDERACIONES", "COMPETENCIA", "CUESTION_PREVIA", "PROBLEMA_JURIDICO", "MARCO_NORMATIVO", "ANALISIS", "CASO_CONCRETO"]
OPERATIVE_SECTION = "PARTE_RESOLUTIVA"
SEPARATE_OPINIONS = ["SALVAMENTO_DE_VOTO", "ACLARACION_DE_VOTO"]
CONTENT_TYPES = {
    "ENCABEZADO": "METADATA",
    "NORMA_DEMANDADA": "QUOTED_MATERIAL",
    "PARTE_RESOLUTIVA": "OPERATIVE_ORDERS",
    "SALVAMENTO_DE_VOTO": "SEPARATE_OPINION",
    "ACLARACION_DE_VOTO": "SEPARATE_OPINION",
    "FIRMAS": "SIGNATURE_BLOCK",
    "PROBLEMA_JURIDICO": "LEGAL_ISSUE",
}
DEFAULT_CONTENT = "REASONING"

# --- fixed values: decisions, first match wins, on folded text -----------------------------------
DECISION_RULES = [
    ("ESTARSE_A_LO_RESUELTO", r"est[ae]rse?\s+a\s+lo\s+resuelto|estese\s+a\s+lo\s+resuelto"),
    ("INEXEQUIBLE", r"inexequib"),
    ("EXEQUIBLE_CONDICIONADA", r"exequib\w*\s+condicional|condicionalmente\s+exequib|exequib.*(?:en\s+el\s+entendido|bajo\s+el\s+entendido|siempre\s+y\s+cuando|siempre\s+que|en\s+el\s+sentido\s+de)"),
    ("EXEQUIBLE", r"exequib"),
    ("INHIBIDA", r"inhib"),
    ("NULIDAD", r"\bnulidad\b|declar\w*\s+(?:la\s+)?nul"),
    ("CONCEDE_TUTELA", r"\b(conceder|tutelar|amparar|proteger)\b"),
    ("NIEGA_TUTELA", r"\b(negar|denegar)\b"),
    ("REVOCA", r"\brevoc"),
    ("CONFIRMA", r"\bconfirm"),
    ("MODIFICA", r"\bmodific"),
]
OTHER_DECISION = "OTRO"
ORDINALS = {
    "primero": 1,
    "segundo": 2,
    "tercero": 3,
    "cuarto": 4,
    "quinto": 5,
    "sexto": 6,
    "septimo": 7,
    "octavo": 8,
    "noveno": 9,
    "decimo": 10,
    "undecimo": 11,
    "duodecimo": 12,
    "decimoprimero": 11,
    "decimosegundo": 12,
    "decimotercero": 13,
    "decimocuarto": 14,
    "decimoquinto": 15,
    "decimosexto": 16,
    "decimoseptimo": 17,
    "decimoctavo": 18,
    "decimonoveno": 19,
    "vigesimo": 20,
}
SCOPE_PATTERN = r"por\s+(?:el\s+cargo|los\s+cargos)\s+(?:analizad\w+|examinad\w+|estudiad\w+)|en\s+relaci[oó]n\s+con\s+(?:el\s+cargo|los\s+cargos)"
CONDITION_PATTERN = r"(?:en\s+el\s+entendido\s+(?:de\s+)?que|bajo\s+el\s+entendido\s+(?:de\s+)?que|siempre\s+y\s+cuando|siempre\s+que)\s+(.+?)(?:\.\s|$)"
CONDITION_MOST = 500

# --- fixed values: citation families in order of precedence: type, pattern, groups -----------------
CITATION_FAMILIES = [
    ("ley", r"\bart[ií]culo\s+(\d+[a-z]?)\s+(?:de\s+la\s+)?(?<!decreto\s)ley\s+(\d+)\s+de\s+(\d{4})\b", ("articulo", "numero", "anio")),
    ("ley", r"(?<!decreto\s)\bley\s+(\d+)\s+de\s+(\d{4})\b", ("numero", "anio")),
    ("decreto", r"\bart[ií]culo\s+(\d+[a-z]?)\s+del\s+decreto\s+(?:ley\s+)?(\d+)\s+de\s+(\d{4})\b", ("articulo", "numero", "anio")),
    ("decreto", r"\bdecreto\s+(?:ley\s+)?(\d+)\s+de\s+(\d{4})\b", ("numero", "anio")),
    ("sentencia", r"\bsentencia\s+([CTASU]{1,2})-(\d+)\s+de\s+(\d{4})\b", ("prefijo", "numero", "anio")),
    ("resolucion", r"\bresoluci[oó]n\s+(\d+)\s+de\s+(\d{4})\b", ("numero", "anio")),
    ("acto_legislativo", r"\bacto\s+legislativo\s+(\d+)\s+de\s+(\d{4})\b", ("numero", "anio")),
    ("constitucion", r"\bart[ií]culo\s+(\d+)\s+(?:de\s+la\s+)?constituci[oó]n", ("articulo",)),
    ("codigo", r"\bc[oó]digo\s+(civil|penal|de\s+procedimiento\s+\w+|sustantivo\s+del\s+trabajo|de\s+comercio|contencioso\s+administrativo|general\s+del\s+proceso)", ("nombre",)),
]

# --- fixed values: portal labels that are not text --------------------------------------------------
INTERFACE_NOISE = r"(?:JURISPRUDENCIA|CONCORDANCIAS|NOTAS?\s+DE\s+VIGENCIA|Afecta\s+la\s+vigencia\s+de|Legislaci[oó]n\s+Anterior)\s*:?\s*\[\s*(?:Mostrar|Ocultar)\s*\]|TEXTO\s+CORRESPONDIENTE\s+A[^\n]*|Afecta\s+la\s+vigencia\s+de\s*:?|\[\s*(?:Mostrar|Ocultar)\s*\]"
ARTICLE_NUMBER = r"Art[ií]culo\s+(?:(Transitorio)\s+)?(\d+)(?:[°ºo]\.)?([A-NP-Za-np-z])?[.]?"

# --- fixed values: chunking -----------------------------------------------------------------------
CHUNK_CHARS, CHUNK_OVERLAP = 3000, 240
CHUNK_NAMESPACE = "6f6c6579-6573-4c45-4759-455343485348"
SENTENCE_END = r"(?<=[.!?])\s+(?=[A-ZÁÉÍÓÚÑ§¿¡])"

# --- fixed values: branches, sectors, courts ---------------------------------------------------------
BRANCHES = ["Rama Ejecutiva", "Rama Legislativa", "Rama Judicial", "Organismos de Control", "Órgano Autónomo", "Órgano Electoral", "Internacional", "Otros"]
EXECUTIVE, LEGISLATIVE, JUDICIAL, CONTROL, AUTONOMOUS, ELECTORAL, INTERNATIONAL, OTHER = BRANCHES
EXECUTIVE_SECTORS = {
    "agricultura y desarrollo rural": "Agricultura y Desarrollo Rural",
    "ambiente y desarrollo sostenible": "Ambiente y Desarrollo Sostenible",
    "ciencia tecnologia e innovacion": "Ciencia, Tecnología e Innovación",
    "comercio industria y turismo": "Comercio, Industria y Turismo",
    "cultura": "Cultura",
    "defensa nacional": "Defensa Nacional",
    "excelencia militar": "Defensa Nacional",
    "deporte": "Deporte",
    "educacion nacional": "Educación Nacional",
    "educacion": "Educación Nacional",
    "estadistica": "Estadística",
    "funcion publica": "Función Pública",
    "hacienda y credito publico": "Hacienda y Crédito Público",
    "igualdad y equidad": "Igualdad y Equidad",
    "inclusion social y reconciliacion": "Inclusión Social y Reconciliación",
    "inteligencia estrategica y contrainteligencia": "Inteligencia Estratégica y Contrainteligencia",
    "interior": "Interior",
    "justicia y del derecho": "Justicia y del Derecho",
    "minas y energia": "Minas y Energía",
    "planeacion": "Planeación",
    "presidencia de la republica": "Presidencia de la República",
    "relaciones exteriores": "Relaciones Exteriores",
    "salud y proteccion social": "Salud y Protección Social",
    "tecnologias de la informacion y de las comunicaciones": "Tecnologías de la Información y las Comunicaciones",
    "trabajo": "Trabajo",
    "transporte": "Transporte",
    "vivienda ciudad y territorio": "Vivienda, Ciudad y Territorio",
}
SPECIAL_SECTORS = {
    "congreso de la republica": (LEGISLATIVE, "Congreso de la República"),
    "rama judicial": (JUDICIAL, "Rama Judicial"),
    "entes de control": (CONTROL, "Organismos de Control"),
    "organismos autonomos e independientes": (AUTONOMOUS, "Organismos Autónomos e Independientes"),
    "organizacion electoral": (ELECTORAL, "Organización Electoral"),
}
COURTS = {
    "cc": (JUDICIAL, "Corte Constitucional"),
    "csj": (JUDICIAL, "Corte Suprema de Justicia"),
    "ce": (JUDICIAL, "Consejo de Estado"),
    "cndj": (JUDICIAL, "Comisión Nacional de Disciplina Judicial"),
    "jep": (JUDICIAL, "Jurisdicción Especial para la Paz"),
    "idh": (INTERNATIONAL, "Sistema Interamericano"),
    "can": (INTERNATIONAL, "Comunidad Andina"),
    "cne": (ELECTORAL, "Consejo Nacional Electoral"),
}
#: Issuers by folded name, first match wins: (pattern, branch, head); a null head comes from the sector.
ISSUER_RULES = [
    (r"^congreso|^poder legislativo|^consejo nacional legislativo|^consejo nacional constituyente|^asamblea nacional|organo legislativo", LEGISLATIVE, "Congreso de la República"),
    (r"corte constitucional", JUDICIAL, "Corte Constitucional"),
    (r"corte suprema", JUDICIAL, "Corte Suprema de Justicia"),
    (r"consejo de estado|contencioso administrativo", JUDICIAL, "Consejo de Estado"),
    (r"fiscalia|rama judicial|disciplina judicial|jurisdiccion especial para la paz|centro de arbitraje", JUDICIAL, "Rama Judicial"),
    (r"procuraduria|contraloria|defensoria del pueblo|ministerio publico|auditoria general", CONTROL, "Organismos de Control"),
    (r"consejo nacional electoral|registraduria", ELECTORAL, "Organización Electoral"),
    (r"banco de la republica|comision nacional del servicio civil|corporacion.*autonoma|autonoma.*corporacion|consejo profesional|unidad de busqueda de personas", AUTONOMOUS, "Organismos Autónomos e Independientes"),
    (r"^comision de regulacion|^creg$|^crc$|^cra$", EXECUTIVE, "Comisiones de Regulación"),
    (r"corte interamericana|comision interamericana", INTERNATIONAL, "Sistema Interamericano"),
    (r"comunidad andina|acuerdo de cartagena|tribunal.*andin|andin.*tribunal|tribunal.*justicia de la comunidad|justicia de la comunidad.*tribunal", INTERNATIONAL, "Comunidad Andina"),
    (r"organizacion internacional|naciones unidas", INTERNATIONAL, "Organismos Internacionales"),
    (r"^ministerio|^departamento administrativo|^superintendencia|^agencia|^unidad administrativa|^instituto|^presidencia|^poder ejecutivo|^direccion", EXECUTIVE, None),
]
LEGISLATURE_NAMES = r"^congreso|^poder legislativo|^consejo nacional legislativo|^asamblea nacional|organo legislativo"
PRESIDENCY_NAMES = r"^poder ejecutivo|^presidencia de la republica$"
LOWER_WORDS = ["de", "del", "la", "las", "los", "y", "e", "en", "el", "para", "a"]
UPPER_WORDS = ["dian", "dimar", "icbf", "sena", "creg", "une", "s.a.", "sa"]
