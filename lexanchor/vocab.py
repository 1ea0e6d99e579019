"""Closed vocabularies, seed rows and text patterns.

Everything in this file is a fixed value: results depend on these exact words,
orders and patterns, so they are written out plainly and used by name elsewhere.
"""

# ---------------------------------------------------------------- taxonomies
# Fixed values: (domain, label, parent)
DOMAINS = [
    ("transversal", "Entidades transversais", None),
    ("normativo", "Sistema normativo", None),
    ("juridico", "Sistema jurídico", None),
    ("executivo", "Poder Executivo", None),
    ("mp", "Ministério Público", None),
    ("legislativo", "Poder Legislativo", None),
    ("controle", "Órgãos de controle", None),
]

# Fixed values: (type, domain, ontological class, label)
OBJECT_TYPES = [
    ("constituicao", "normativo", "estrutural", "Constituição"),
    ("versao_normativa", "normativo", "estrutural", "Versão/marco temporal de obra normativa"),
    ("emenda_constitucional", "normativo", "estrutural", "Emenda Constitucional"),
    ("titulo", "normativo", "estrutural", "Título"),
    ("capitulo", "normativo", "estrutural", "Capítulo"),
    ("secao", "normativo", "estrutural", "Seção"),
    ("artigo", "normativo", "estrutural", "Artigo"),
    ("caput", "normativo", "estrutural", "Caput"),
    ("inciso", "normativo", "estrutural", "Inciso"),
    ("paragrafo", "normativo", "estrutural", "Parágrafo"),
    ("alinea", "normativo", "estrutural", "Alínea"),
    ("acao_direta", "juridico", "processual", "Ação Direta"),
    ("recurso_extraordinario", "juridico", "processual", "Recurso Extraordinário"),
    ("sumula_vinculante", "juridico", "estrutural", "Súmula Vinculante"),
    ("decreto", "executivo", "estrutural", "Decreto"),
    ("projeto_lei", "legislativo", "processual", "Projeto de Lei"),
    ("subject", "transversal", "semantico", "Tema/assunto"),
    ("anotacao", "transversal", "editorial", "Anotação editorial"),
    ("argumento", "juridico", "argumentativo", "Razão de decidir / fundamento"),
    ("impacto_orcamentario", "transversal", "analitico", "Impacto orçamentário de decisão"),
    ("estimativa_fiscal", "transversal", "analitico", "Estimativa fiscal quantificada"),
    ("nota_tecnica_fiscal", "transversal", "editorial", "Nota técnica sobre impacto fiscal"),
    ("ente_orcamentario", "transversal", "estrutural", "Ente ou centro de impacto orçamentário"),
    ("resultado_decisorio", "juridico", "preditivo", "Sinal de resultado de julgamento"),
    ("fundamento", "juridico", "argumentativo", "Fundamento jurídico"),
    ("tese", "juridico", "argumentativo", "Tese fixada ou proposta"),
    ("registro_jurisprudencial", "juridico", "editorial", "Registro jurisprudencial"),
    ("processo", "juridico", "processual", "Processo judicial com identidade autônoma"),
    ("divisor_editorial", "juridico", "editorial", "Marcador de início de camada editorial"),
]

# Fixed values: (type, domain, actor class, label)
ACTOR_TYPES = [
    ("ministro_stf", "juridico", "institucional", "Ministro do STF"),
    ("presidente", "executivo", "institucional", "Presidente da República"),
    ("procurador_geral", "mp", "institucional", "Procurador-Geral da República"),
    ("senador", "legislativo", "institucional", "Senador"),
    ("deputado", "legislativo", "institucional", "Deputado Federal"),
    ("sistema", "transversal", "automatizado", "Ator automatizado (pipeline, IA)"),
    ("tribunal", "juridico", "institucional", "Tribunal"),
    ("turma", "juridico", "institucional", "Turma / Órgão julgador"),
]

# Fixed values: (type, domain, event class, label)
EVENT_TYPES = [
    ("julgamento", "juridico", "juridico", "Julgamento"),
    ("distribuicao", "juridico", "juridico", "Distribuição"),
    ("publicacao_dje", "juridico", "juridico", "Publicação no DJe"),
    ("promulgacao", "normativo", "normativo", "Promulgação"),
    ("emenda_aplicada", "normativo", "normativo", "Aplicação de emenda constitucional"),
    ("nomeacao", "executivo", "juridico", "Nomeação"),
    ("mudanca_estado", "transversal", "manutencao", "Transição de estado"),
    ("correcao", "transversal", "manutencao", "Correção de dado existente"),
    ("anulacao", "transversal", "manutencao", "Anulação de dado incorreto"),
    ("criacao", "transversal", "manutencao", "Registro de criação"),
    ("alocacao_risco_fiscal", "juridico", "fiscal", "Redistribuição de risco fiscal"),
    ("modulacao_efeitos_fiscais", "juridico", "fiscal", "Modulação de efeitos com impacto fiscal"),
    ("formacao_resultado", "juridico", "juridico", "Formação de resultado decisório"),
]

# Fixed values: (type, source domain, target domain, epistemic class, label,
#                bidirectional, allows_multiple, weight semantics, weight_required)
EDGE_TYPES = [
    ("parent_of", None, None, "estrutural", "relação hierárquica", False, False, None, False),
    ("version_of", "normativo", "normativo", "estrutural", "versão de uma obra", False, False, None, False),
    ("amends", "normativo", "normativo", "normativa", "emenda altera dispositivo", False, True, None, False),
    ("emenda", "legislativo", "normativo", "normativa", "emenda constituição", False, True, None, False),
    ("veta", "executivo", "legislativo", "normativa", "veta projeto", False, False, None, False),
    ("interpreta", "juridico", "normativo", "interpretativa", "interpreta dispositivo", False, True, "confidence (0-1)", True),
    ("aplica", "juridico", "normativo", "interpretativa", "aplica norma", False, True, "confidence (0-1)", True),
    ("questiona", "juridico", "normativo", "interpretativa", "questiona constitucionalidade", False, True, "confidence (0-1)", True),
    ("sobre", None, None, "classificatoria", "vincula a subject/tema", False, True, "relevancia (0-1)", False),
    ("annota", None, None, "editorial", "anotação ao alvo", False, True, None, False),
    ("exerce_papel", None, None, "institucional", "actor exerce papel em contexto", False, True, None, False),
    ("sucede", None, None, "institucional", "actor sucede outro", False, False, None, False),
    ("relator_de", "juridico", "juridico", "institucional", "relator do processo", False, False, None, False),
    ("nomeia_ministro", "executivo", "juridico", "institucional", "nomeia ministro", False, False, None, False),
    ("denuncia", "mp", "juridico", "institucional", "oferece denúncia", False, True, None, False),
    ("suporta", "juridico", "juridico", "argumentativa", "fundamento suporta decisão", False, True, "forca (0-1)", False),
    ("contradiz", "juridico", "juridico", "argumentativa", "argumento contradiz argumento", False, True, "forca (0-1)", False),
    ("fundamenta_em", "juridico", "normativo", "argumentativa", "argumento se fundamenta em norma", False, True, "confidence (0-1)", False),
    ("fundamenta", "juridico", "juridico", "argumentativa", "fundamento embasa decisão", False, True, "forca (0-1)", False),
    ("apoia", "juridico", "juridico", "argumentativa", "fundamento/tese apoia outro", False, True, "forca (0-1)", False),
    ("confirma", "juridico", "juridico", "argumentativa", "decisão confirma precedente", False, True, "confidence (0-1)", False),
    ("supera", "juridico", "juridico", "argumentativa", "decisão supera precedente", False, True, "confidence (0-1)", False),
    ("impacta_orcamento", "juridico", "transversal", "fiscal", "decisão impacta orçamento de ente", False, True, "magnitude (0-1)", True),
    ("aloca_risco_fiscal", "juridico", "transversal", "fiscal", "decisão redistribui risco fiscal", False, True, "magnitude (0-1)", True),
    ("quantifica", "transversal", "transversal", "fiscal", "vincula estimativa a impacto", False, True, "confidence (0-1)", False),
    ("mitiga_impacto", "juridico", "juridico", "fiscal", "modulação mitiga impacto fiscal", False, True, "eficacia (0-1)", False),
    ("externaliza_risco", "juridico", "transversal", "fiscal", "decisão transfere risco a terceiro", False, True, "magnitude (0-1)", False),
    ("decide_em_favor_de", "juridico", "transversal", "preditiva", "decisão favorece parte/ente", False, True, "confidence (0-1)", False),
    ("gera_impacto_orcamentario", "juridico", "transversal", "fiscal", "decisão gera impacto orçamentário", False, True, "magnitude (0-1)", False),
    ("modula", "juridico", "juridico", "fiscal", "decisão modula efeitos", False, True, "eficacia (0-1)", False),
    ("ancora_normativa", "juridico", "normativo", "interpretativa", "registro incide sobre dispositivo", False, True, "confidence (0-1)", True),
    ("ancora_processual", "juridico", "juridico", "estrutural", "registro pertence a processo", False, True, None, False),
    ("cita", "juridico", "juridico", "argumentativa", "decisão cita precedente", False, True, "forca (0-1)", False),
    ("fixa_tese", "juridico", "juridico", "interpretativa", "decisão fixa tese vinculante", False, False, None, False),
    ("produzido_por", "juridico", "juridico", "institucional", "processo produzido por tribunal", False, False, None, False),
]

# Fixed values: (state, object type, domain, label, terminal)
STATE_TYPES = [
    ("vigente", "artigo", "normativo", "Vigente", False),
    ("vigente", "inciso", "normativo", "Vigente", False),
    ("vigente", "paragrafo", "normativo", "Vigente", False),
    ("suspensa", "artigo", "normativo", "Suspensa por liminar", False),
    ("revogada", "artigo", "normativo", "Revogada", True),
    ("distribuida", "acao_direta", "juridico", "Distribuída", False),
    ("pautada", "acao_direta", "juridico", "Pautada", False),
    ("julgada", "acao_direta", "juridico", "Julgada", False),
    ("transitada", "acao_direta", "juridico", "Transitada em julgado", True),
    ("pendente", "processo", "juridico", "Pendente", False),
    ("pautado", "processo", "juridico", "Pautado", False),
    ("julgado", "processo", "juridico", "Julgado", False),
    ("publicado", "processo", "juridico", "Publicado", False),
    ("transitado", "processo", "juridico", "Transitado", True),
    ("superado", "processo", "juridico", "Superado", True),
]

# Allowed lists of the provenance and learning tables.
TARGET_TABLES = ["objects", "actors", "events", "edges"]
SOURCE_TYPES = ["manual", "scraping", "parsing", "pipeline", "ia"]
PROFILE_TYPES = ["relator", "orgao", "relator_orgao", "relator_environment", "orgao_environment"]
PROFILE_STATUS = ["proposed", "validated", "incorporated", "rejected", "superseded"]
PROPOSAL_TYPES = [
    "new_decision_pattern", "new_reasoning_pattern", "new_fiscal_pattern", "new_predictive_feature",
    "new_body_pattern", "new_relator_pattern", "new_environment_pattern",
]
PROPOSAL_STATUS = ["pending", "validated", "incorporated", "rejected"]

# ------------------------------------------------------------------- editorial
# Display rank of a block by its decision unit type.
UNIT_RANK = {
    "sumula_vinculante": 1, "sumula": 2, "controle_concentrado": 3, "repercussao_geral": 4,
    "julgado_correlato": 5, "julgado_principal": 6, "comentario_editorial": 7,
}
UNIT_RANK_DEFAULT = 8
# Display rank by editorial marker.
MARKER_RANK = {
    "sumula_vinculante": 1, "sumula": 2, "controle_concentrado": 3, "repercussao_geral": 4,
    "julgados_correlatos": 5, "julgado_correlato": 5, "sem_categoria": 6, "": 7,
}
MARKER_RANK_DEFAULT = 6
# Marker found by containment, tried in this order.
MARKER_WORDS = [
    (["súmula vinculante", "sumula vinculante"], "sumula_vinculante"),
    (["controle concentrado", "controle de concentrado"], "controle_concentrado"),
    (["repercussão geral", "repercussao geral"], "repercussao_geral"),
    (["julgado correlato", "julgados correlatos"], "julgados_correlatos"),
    (["súmula", "sumula"], "sumula"),
]
# Marker lines, tried in this order (anchored at line start).
MARKER_LINES = [
    (r"(?i)^Controle\s+concentrado", "controle_concentrado"),
    (r"(?i)^Controle\s+de\s+concentrado", "controle_concentrado"),
    (r"(?i)^Repercuss[aã]o\s+geral", "repercussao_geral"),
    (r"(?i)^Julgados?\s+[Cc]orrelatos?", "julgados_correlatos"),
    (r"(?i)^S[uú]mulas?\s+[Vv]inculantes?", "sumula_vinculante"),
    (r"(?i)^S[uú]mulas?\s*$", "sumula"),
]
# Prefixes taken off the start of a block, first match only.
EDITORIAL_PREFIXES = [
    "Controle concentrado de constitucionalidade", "Controle de concentrado de constitucionalidade",
    "Repercussão geral", "Repercussão Geral", "Súmula Vinculante", "Súmula vinculante",
    "Julgados correlatos", "Julgado correlato", "Julgados Correlatos", "Julgado Correlato",
    "Súmula", "Preâmbulo",
]
# Words that make a short text an editorial marker.
MARKER_HINTS = ["controle", "repercuss", "julgado", "súmula", "sumula", "correlato"]

# --------------------------------------------------------------- text patterns
# Process classes in alternation order.
CLASSES = (
    "ADI|ADC|ADPF|ADO|RE|ARE|HC|RHC|MS|MI|AP|ACO|Rcl|AI|Pet|SS|SL|IF|Inq|Ext|AC|AgR|ED|MC|QO|SV|PSV|"
    "AO|AR|RMS|CR|Rp|STA"
)
CLASSES_LINKS = CLASSES + "|STP"
CLASSES_STRICT = "ADI|ADC|ADO|ADPF|ARE|RE|RHC|HC|MS|Pet|Inq|Ext|Rcl|REsp|AgR|AI|SL|SS|STA"
CLASSES_CITED = (
    "ADI|ADPF|ADC|ADO|RE|ARE|HC|RHC|MS|MI|AP|ACO|Rcl|AI|Pet|SS|SL|IF|Inq|Ext|AC|AgR|ED|MC|QO|SV|PSV|"
    "AO|AR|RMS|CR|Rp"
)

# Case-metadata patterns.
P_PROC = rf"(?i)\b({CLASSES})\s*[\-n.\s]*([\d][\d.,]*)"
P_PROC_LINKS = rf"(?i)\b({CLASSES_LINKS})\s*[\-n.\s]*([\d][\d.,]*)"
P_PROC_STRICT = rf"(?i)\b({CLASSES_STRICT})\s+([\d\.\-]+)"
P_REL = r"(?i)rel\.?\s*(?:p/\s*o?\s*ac\.?\s*)?min\.?\s*([^,\]\.\n]+)"
P_REL_STRICT = r"(?i)rel\.\s*min\.\s*([^,\]\.;]+)"
P_RED = r"(?i)red\.?\s*(?:do\s+ac\.?\s*)?min\.?\s*([^,\]\.\n]+)"
P_VOTO = r"(?i)voto\s+d[oa]\s*(?:rel\.?\s*)?min\.?\s*([^,\]\.\n]+)"
P_JULG = r"(?i)j\.\s*(\d[\d\-/]+(?:\s*de\s*[\w\p{L}]+\s*de\s*\d+)?)"
P_JULG_STRICT = r"(?i)\bj\.\s*([\dºo°\.\-/]+)"
P_JULG_LINKS = r"(?i)j\.\s*(\d[\d\-/]+(?:\s*(?:de\s*)?[\w\p{L}]+\s*(?:de\s*)?\d{4})?)"
P_DJE = r"(?i)D[Jj][Ee]?\s*de\s*(\d[\d\-/]+)"
P_DJE_STRICT = r"(?i)DJE\s+de\s+([\dºo°\.\-/]+)"
P_DJE_LINKS = r"(?i)D[Jj][Ee]?\s*de\s*(\d[\d\-/]+(?:\s*(?:de\s*)?[\w\p{L}]+\s*(?:de\s*)?\d{4})?)"
P_DJ = r"(?i)\bDJ\s+de\s*(\d[\d\-/]+)"
P_TEMA = r"[Tt]ema\s*(\d+)"
P_TEMA_STRICT = r"(?i)\bTema\s+([\d\.\-]+)"
P_SV = r"(?i)S[uú]mula\s+Vinculante\s*n?[oº°]?\s*(\d+)"
P_SV_STRICT = r"(?i)\bS[uú]mula\s+Vinculante\s+(\d+)"
P_SUMULA = r"(?i)S[uú]mula\s*n?[oº°]?\s*(\d+)"
P_TURMA = r"(?i)(\d)ª?\s*T\b|Plen[áa]rio|\bP\b,"
P_MERITO = r"(?i)com\s+m[ée]rito\s+julgado"
P_PENDENTE = r"(?i)m[ée]rito\s+pendente"
P_BRACKET = r"\[([^\]]{10,})\]"
P_BRACKET_END = r"\[([^\]]{10,})\]\s*$"
P_CITED = r"\[([A-Z]{2,}[^\]]{5,}?)\]"
P_YEAR = r"j\.\s+\d{1,2}[-\./]\d{1,2}[-\./](\d{4})"

# Commentary line classes.
P_META_LINE = rf"(?i)^\[.*({CLASSES}).*\]$"
P_META_LINE2 = rf"(?i)^\[?\s*({CLASSES})[\s\.\-]*\d"
P_SUM_LINE = r"(?i)^\[?\s*S[uú]mula\s+(Vinculante\s+)?n?[oº°]?\s*\d+"
P_ART_LINE = r"^Art\.?\s*(\d+)[º°]?"
P_PAR_LINE = r"(?i)^§\s*(\d+|[uú]nico)[º°]?\s"
P_PAR_UNICO_LINE = r"(?i)^Par[aá]grafo\s+[uú]nico"
# the inciso pattern reads the whole Roman range, in any length of numeral
P_INC_LINE = r"^([IVXLC]+)\s*[-–—]\s*\S"
P_ALI_LINE = r"^([a-z])\)\s"
P_ADCT_HEADER = r"(?i)^ATO DAS DISPOSI"

# Tails after "Art. N" that mean another statute is cited.
CROSS_REFERENCE_TAILS = [
    r"^\s*,?\s*§", r"^\s*,?\s*caput", r"^\s*,?\s*incisos?", r"^\s*,?\s*par[aá]grafo\s+[uú]nico",
    r"^\s*,?\s*[IVX]+\s*[\(\,\.\-]", r"^\s+e\s+art\.", r"^\s*/\s*art\.", r"^\s+da\s+Lei\b", r"^\s+do\s+C[oó]digo",
    r"^\s+da\s+CLT\b", r"^\s+do\s+CPC\b", r"^\s+do\s+CP\b", r"^\s+do\s+CTN", r"^\s+da\s+LC\b",
    r"^\s+Lei\s+Complementar", r"^\s+da\s+Constitui[çc][ãa]o\s+do\s+Estado", r"^\s+da\s+Lei\s+Org[âa]nica",
    r"^\s+do\s+Estatuto", r"^\s+do\s+Decreto", r"^\s+da\s+Resolu[çc][ãa]o", r"^\s+c/c\b",
    r"[oO°º]\s+do\s+(CPP|CPC|CP\b|ECA|CDC|CTB|LOMAN|RISTF|LEP)", r"^\s+Decreto-lei",
]

# Norm-tree line classes in trial order, with the capture that
# holds the number and the one that holds the trailing text (0 = none).
ROMAN = "[IVXLCDM]+"
TREE_LINES = [
    ("preambulo", r"(?i)^\s*PRE[ÂA]MBULO\s*$", 0, 0),
    ("titulo", rf"(?i)^\s*T[IÍ]TULO\s+({ROMAN})\s*$", 1, 0),
    ("capitulo", rf"(?i)^\s*CAP[IÍ]TULO\s+({ROMAN})\s*$", 1, 0),
    ("secao", rf"(?i)^\s*SE[CÇ][AÃ]O\s+({ROMAN})\s*$", 1, 0),
    ("subsecao", rf"(?i)^\s*SUBSE[CÇ][AÃ]O\s+({ROMAN})\s*$", 1, 0),
    ("artigo", r"(?i)^\s*Art\.?\s*(\d+)(?:[ºo°])?\s*[–\-—.]?\s*(.*)$", 1, 2),
    ("paragrafo_unico", r"(?i)^\s*Par[aá]grafo\s+[uú]nico\s*[–\-—.]?\s*(.*)$", 0, 1),
    ("paragrafo", r"(?i)^\s*§\s*(\d+)(?:[ºo°])?\s*[–\-—.]?\s*(.*)$", 1, 2),
    ("inciso", rf"(?i)^\s*({ROMAN})\s*[-–—]\s*(.*)$", 1, 2),
    ("alinea", r"(?i)^\s*([a-z])\)\s*(.*)$", 1, 2),
    ("item", r"(?i)^\s*(\d+)\.\s*(.*)$", 1, 2),
]
# Node types and the types each may hang under.
TREE_PARENTS = {
    "preambulo": ["root"],
    "titulo": ["root", "preambulo"],
    "capitulo": ["titulo", "subsecao", "secao"],
    "secao": ["titulo", "capitulo", "subsecao"],
    "subsecao": ["secao", "capitulo", "titulo"],
    "artigo": ["titulo", "capitulo", "secao", "subsecao", "root"],
    "paragrafo": ["artigo"],
    "inciso": ["artigo", "paragrafo"],
    "alinea": ["inciso", "paragrafo"],
    "item": ["alinea", "inciso", "paragrafo"],
}
# Slug segment of each node type.
TREE_SEGMENT = {
    "titulo": "tit", "capitulo": "cap", "secao": "sec", "subsecao": "subsec", "artigo": "art",
    "paragrafo": "par", "inciso": "inc", "alinea": "ali", "item": "item",
}
TITLE_MAX = 180

# Editorial prefixes removed from comparison keys.
ASCII_KEY_PREFIX = (
    r"^(controle\s+(de\s+)?concentrado\s+de\s+constitucionalidade|repercuss.o\s+geral|s.mula\s+vinculante|"
    r"s.mula|julgados?\s+correlatos?|pre.mbulo)\s*"
)
WORD_KEY_PREFIXES = [
    "controle concentrado de constitucionalidade", "controle de concentrado de constitucionalidade",
    "repercussao geral", "sumula vinculante", "sumula", "julgados correlatos", "julgado correlato", "preambulo",
]

# HTML entities that decode to a character; other named ones vanish.
ENTITIES = [
    ("&nbsp;", " "), ("&ordm;", "º"), ("&ordf;", "ª"), ("&ldquo;", '"'), ("&rdquo;", '"'), ("&lsquo;", "'"),
    ("&rsquo;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&sect;", "§"), ("&amp;", "&"),
]

# Accent folding over the Latin letters used by the corpus.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"

# Person-name aliases to canonical names (empty = not a name).
NAME_ALIASES = {
    "Al": "", "O": "", "Sep": "Sepúlveda Pertence", "Ceza": "Cezar Peluso", "Cezar Pel": "Cezar Peluso",
    "Cezar Pelus": "Cezar Peluso", "Dias": "Dias Toffoli", "Eros Gr": "Eros Grau", "Marco": "Marco Aurélio",
    "Marco A": "Marco Aurélio", "Marco Aur": "Marco Aurélio", "Nelson": "Nelson Jobim",
    "Nelson Job": "Nelson Jobim", "Ricardo Le": "Ricardo Lewandowski", "Luís Rober": "Luís Roberto Barroso",
    "Marco Aurelio": "Marco Aurélio", "Carmen Lúcia": "Cármen Lúcia", "Carmén Lúcia": "Cármen Lúcia",
    "Alexandre Moraes": "Alexandre de Moraes", "Dias Tofolli": "Dias Toffoli",
    "Sidney Sanches": "Sydney Sanches", "Rosa Werber": "Rosa Weber", "Carlos Britto": "Ayres Britto",
    "Ayres Britto)": "Ayres Britto", "Luís Roberto Barroso-": "Luís Roberto Barroso",
    "Roberto Barroso": "Luís Roberto Barroso",
}
# The shorter alias list used while names are being extracted.
EXTRACT_ALIASES = {
    k: NAME_ALIASES[k]
    for k in [
        "Roberto Barroso", "Marco Aurelio", "Carmen Lúcia", "Carmén Lúcia", "Alexandre Moraes", "Dias Tofolli",
        "Sidney Sanches", "Rosa Werber", "Carlos Britto",
    ]
}
P_NAME_HEAD = (
    r"^([A-ZÀ-Ú][a-záéíóúàâêôãõçü]+(?:\s+(?:de\s+)?[A-ZÀ-Ú][a-záéíóúàâêôãõçü]+){0,3})"
)

# -------------------------------------------------------------------- linkage
# Variants that never identify a node.
AMBIGUOUS = ["i", "ii", "iii", "iv", "v", "1", "2", "3", "4", "5", "a", "b", "c", "d", "e"]
# Score added per node type, and confidence bonus per node type.
SPECIFICITY = {
    "alinea": 100, "item": 95, "inciso": 90, "paragrafo": 85, "artigo": 80, "subsecao": 70, "secao": 65,
    "capitulo": 60, "titulo": 55, "preambulo": 50,
}
TYPE_BONUS = {"alinea": 0.04, "inciso": 0.03, "paragrafo": 0.025, "artigo": 0.02}
SAME_NAMESPACE, OTHER_NAMESPACE = 50, -20
# Fixed values: (pattern, templates; %s is the capture, "U"/"L" its case).
CANDIDATE_RULES = [
    (r"(?i)\bArt\.?\s*(\d+)(?:[ºo°])?\b", "", ["Art. %sº", "Art. %s", "Artigo %s"]),
    (r"(?i)Par[aá]grafo\s+[uú]nico", "C", ["Parágrafo único", "Paragrafo unico", "§ único"]),
    (r"(?i)§\s*(\d+)(?:[ºo°])?", "", ["§ %sº", "§ %s", "Parágrafo %s", "Paragrafo %s", "Par %s"]),
    (r"(?i)\b([IVXLCDM]+)\s*[-–—]", "U", ["%s -", "Inciso %s", "Inc. %s", "Inc %s"]),
    (r"(?i)\binc(?:iso|\.)?\s+([IVXLCDM]+)\b", "U", ["Inciso %s", "Inc. %s", "Inc %s", "%s -"]),
    (r"(?i)\binc(?:iso|\.)?\s+(\d+)\b", "", ["Inciso %s", "Inc. %s", "Inc %s", "%s -"]),
    (r"(?i)\b([a-z])\)", "L", ["%s)", "Alínea %s", "Alinea %s", "Ali %s"]),
    (r"(?i)\bal[ií]nea\s+([a-z])\b", "L", ["Alínea %s", "Alinea %s", "Ali %s", "%s)"]),
    (r"(?i)\bT[íi]tulo\s+([IVXLCDM]+|\d+)\b", "", ["Título %s", "Titulo %s"]),
    (r"(?i)\bCap[íi]tulo\s+([IVXLCDM]+|\d+)\b", "", ["Capítulo %s", "Capitulo %s"]),
    (r"(?i)\bSe[cç][aã]o\s+([IVXLCDM]+|\d+)\b", "", ["Seção %s", "Secao %s"]),
    (r"(?i)\bSubse[cç][aã]o\s+([IVXLCDM]+|\d+)\b", "", ["Subseção %s", "Subsecao %s"]),
]
P_ADCT = r"(?i)\bADCT\b"
P_ART_MENTION = r"(?i)\bArt\.?\s*(\d+)(?:[ºo°])?\b"
# Variant templates per node type: (template, source, origin, priority);
# source R = Roman/raw number, N = number as integer, L = letter.
_H = {"titulo": ("Título", "Titulo", 85, 80), "capitulo": ("Capítulo", "Capitulo", 85, 80),
      "secao": ("Seção", "Secao", 85, 80), "subsecao": ("Subseção", "Subsecao", 80, 75)}
_O = {"titulo": "titulo", "capitulo": "cap", "secao": "sec", "subsecao": "subsec"}
VARIANTS = {
    t: [
        (a + " %s", "R", f"{_O[t]}_romano", 100), (b + " %s", "R", f"{_O[t]}_romano_sa", 95),
        (a + " %s", "N", f"{_O[t]}_arab", p), (b + " %s", "N", f"{_O[t]}_arab_sa", q),
    ]
    for t, (a, b, p, q) in _H.items()
}
VARIANTS.update({
    "preambulo": [("Preâmbulo", "", "preambulo_formal", 100), ("Preambulo", "", "preambulo_sem_acento", 95)],
    "artigo": [
        ("Art. %sº", "N", "art_formal", 100), ("Art. %s", "N", "art_sem_ord", 98),
        ("Art %sº", "N", "art_sem_ponto", 95), ("Art %s", "N", "art_minimo", 93),
        ("Artigo %s", "N", "art_extenso", 90),
    ],
    "artigo_adct": [("ADCT Art. %s", "N", "adct_art_formal", 110), ("Art. %s do ADCT", "N", "adct_art_pos", 108)],
    "paragrafo_unico": [
        ("Parágrafo único", "", "par_unico", 100), ("Paragrafo unico", "", "par_unico_sa", 95),
        ("§ único", "", "par_unico_simb", 90),
    ],
    "paragrafo": [
        ("§ %sº", "N", "par_formal", 100), ("§ %s", "N", "par_sem_ord", 98), ("§%sº", "N", "par_colado", 96),
        ("§%s", "N", "par_colado_so", 94), ("Parágrafo %s", "N", "par_extenso", 88),
        ("Paragrafo %s", "N", "par_extenso_sa", 85), ("Par %s", "N", "par_abrev", 75),
    ],
    "inciso": [
        ("%s", "R", "inc_romano_nu", 30), ("%s -", "R", "inc_romano_hif", 100),
        ("Inciso %s", "R", "inc_romano_ext", 95), ("Inc. %s", "R", "inc_romano_abr", 90),
        ("Inc %s", "R", "inc_romano_cur", 88), ("%s", "N", "inc_arab_nu", 20), ("%s -", "N", "inc_arab_hif", 97),
        ("Inciso %s", "N", "inc_arab_ext", 94), ("Inc. %s", "N", "inc_arab_abr", 90),
        ("Inc %s", "N", "inc_arab_cur", 88),
    ],
    "alinea": [
        ("%s)", "L", "ali_formal", 100), ("%s", "L", "ali_nua", 15), ("Alínea %s", "L", "ali_extenso", 92),
        ("Alinea %s", "L", "ali_extenso_sa", 90), ("Ali %s", "L", "ali_abrev", 75),
    ],
    "item": [("%s.", "N", "item_formal", 100), ("%s", "N", "item_nu", 10), ("Item %s", "N", "item_extenso", 85)],
})

# Text-only expansion of an index row, by node type.
EXPANSION = {
    "inciso": ["{r}", "{r} -", "{r} –", "{r} —", "{n}", "{n} -", "inc {n}", "inciso {n}", "inciso {r}", "inc {r}"],
    "paragrafo_unico": ["paragrafo unico", "par unico"],
    "paragrafo": ["§ {n}", "§{n}", "§ {n}º", "paragrafo {n}", "par {n}", "{n}"],
    "alinea": ["{n})", "{n}", "alinea {n}", "ali {n}"],
}

# ------------------------------------------------------------------- contract
# Field levels per type. OBR required, REC recommended, INF derivable,
# PRO forbidden, EXT needs extraction_method and confidence_score, COL required when collegiate.
CONTRACT = {
    ("objects", "constituicao"): {"OBR": "title jurisdiction promulgation_date", "REC": "source_url", "INF": "total_amendments"},
    ("objects", "titulo"): {"OBR": "text_content sibling_order numero_romano", "REC": "numero_int", "INF": "path_slug depth_level is_leaf"},
    ("objects", "capitulo"): {"OBR": "text_content sibling_order numero_romano", "REC": "numero_int", "INF": "path_slug depth_level"},
    ("objects", "secao"): {"OBR": "text_content sibling_order numero_romano", "REC": "numero_int", "INF": "path_slug depth_level"},
    ("objects", "artigo"): {"OBR": "text_content sibling_order", "REC": "numero_texto adct", "INF": "path_slug depth_level is_leaf is_repealed normalized_text"},
    ("objects", "caput"): {"OBR": "text_content", "INF": "normalized_text"},
    ("objects", "inciso"): {"OBR": "text_content sibling_order", "REC": "numero_romano", "INF": "normalized_text"},
    ("objects", "paragrafo"): {"OBR": "text_content sibling_order", "REC": "tipo numero_texto", "INF": "normalized_text"},
    ("objects", "alinea"): {"OBR": "text_content sibling_order", "REC": "letra", "INF": "normalized_text"},
    ("objects", "acao_direta"): {"OBR": "process_number court class_code", "REC": "rapporteur judgment_date source_url", "INF": "hash_content", "PRO": "is_repealed current_state"},
    ("objects", "recurso_extraordinario"): {"OBR": "process_number court class_code", "REC": "rapporteur judgment_date source_url tema_rg leading_case", "INF": "hash_content", "PRO": "is_repealed current_state"},
    ("objects", "sumula_vinculante"): {"OBR": "numero enunciado", "REC": "data_aprovacao situacao"},
    ("objects", "emenda_constitucional"): {"OBR": "numero data ementa", "REC": "artigos_alterados"},
    ("objects", "subject"): {"OBR": "label", "REC": "area"},
    ("objects", "anotacao"): {"OBR": "text annotation_type", "REC": "author"},
    ("objects", "argumento"): {"OBR": "text_content argument_type", "REC": "direction ministro_slug", "EXT": "direction"},
    ("objects", "fundamento"): {"OBR": "text_content fundamento_type", "REC": "extraction_method confidence_score"},
    ("objects", "tese"): {"OBR": "text_content binding fixation_date status", "REC": "tema_rg"},
    ("objects", "resultado_decisorio"): {"OBR": "outcome outcome_polarity decision_unanimity merits_reached extraction_method confidence_score"},
    ("objects", "impacto_orcamentario"): {"OBR": "decisao_slug ente_afetado direcao horizonte_temporal extraction_method confidence_score", "REC": "estimativa_brl retroatividade base_documental"},
    ("objects", "estimativa_fiscal"): {"OBR": "valor_brl metodologia fonte data_referencia confianca"},
    ("objects", "ente_orcamentario"): {"OBR": "label ente_type"},
    ("events", "julgamento"): {
        "OBR": "outcome decision_direction uses_modulation reasoning_style fiscal_effect decision_body adjudication_environment collegiality_mode extraction_method confidence_score",
        "REC": "session_format oral_argument_present public_debate_intensity outcome_polarity decision_unanimity merits_reached divergence_present",
        "EXT": "decision_direction uses_modulation reasoning_style fiscal_effect rights_effect state_constraint temporal_effect injunctive_profile deference_level fiscal_risk_shift retroactive_liability",
        "COL": "panel_size votes_present",
        "PRO": "relator composicao subjects artigos_atingidos",
    },
    ("events", "mudanca_estado"): {"OBR": "from_state to_state", "REC": "reason"},
    ("events", "correcao"): {"OBR": "hash_anterior", "REC": "campo_corrigido valor_anterior valor_novo reason"},
    ("events", "anulacao"): {"OBR": "reason", "REC": "hash_anulado"},
    ("events", "criacao"): {"REC": "source_description"},
    ("events", "emenda_aplicada"): {"OBR": "emenda_slug action node_afetado"},
    ("events", "distribuicao"): {"REC": "relator_slug classe"},
    ("events", "formacao_resultado"): {"OBR": "resultado_slug", "REC": "votos_favor votos_contra"},
    ("edges", "exerce_papel"): {"OBR": "role"},
    ("edges", "interpreta"): {"OBR": "weight extraction_method"},
    ("edges", "aplica"): {"OBR": "weight extraction_method"},
    ("edges", "questiona"): {"OBR": "weight extraction_method"},
    ("edges", "impacta_orcamento"): {"OBR": "weight direcao", "REC": "estimativa_brl horizonte_temporal confianca"},
    ("edges", "aloca_risco_fiscal"): {"OBR": "weight direcao", "REC": "estimativa_brl horizonte_temporal confianca"},
    ("edges", "suporta"): {"REC": "weight"},
    ("edges", "contradiz"): {"REC": "weight"},
    ("edges", "fundamenta"): {"REC": "weight"},
    ("edges", "apoia"): {"REC": "weight"},
    ("edges", "confirma"): {"REC": "weight extraction_method"},
    ("edges", "supera"): {"REC": "weight extraction_method"},
    ("edges", "parent_of"): {"PRO": "weight payload"},
    ("edges", "relator_de"): {"PRO": "weight"},
}

# Fields a complete collegiate judgment must carry.
COMPLETE_JUDGMENT = [
    "outcome", "decision_body", "adjudication_environment", "panel_size", "votes_present", "extraction_method",
    "confidence_score",
]

# The fourteen axis pairs of the correlation report.
AXIS_PAIRS = [
    ("period", "environment"), ("relator", "environment"), ("body", "environment"), ("relator", "body"),
    ("relator", "actor"), ("subject", "environment"), ("subject", "actor"), ("class", "environment"),
    ("class", "actor"), ("outcome", "environment"), ("direction", "environment"), ("modulation", "environment"),
    ("fiscal", "actor"), ("fiscal", "environment"),
]


# Patterns of bracketed citations and of sub-devices named in texts.
CITED_HEAD = rf"^({CLASSES_CITED})\s*[-n.]*\s*([\d.]+(?:[-/]\d+)?)"
CITED_REL = r"rel\.?\s*(?:p/\s*o?\s*ac\.?\s*)?min\.?\s*([^,\]]+)"
CITED_BODY = r",\s*(P|1.?\s*T|2.?\s*T)\s*[,\]]"
CITED_DATE = r"j\.\s*(\d[\d\-]+(?:\s*de\s*[\w\p{L}]+\s*de\s*\d+)?)"
GRANULAR_INC = r"""\b[Aa]rt\.?\s*(\d+)[º°o]?,\s*(?:inc(?:iso|\.)?\s+)?([IVXLCDM]+)\b(?:,\s*(?:al[ií]nea\s+)?["“']?([a-z])\b)?"""
GRANULAR_PAR = r"\b[Aa]rt\.?\s*(\d+)[º°o]?,\s*§\s*(\d+)"
