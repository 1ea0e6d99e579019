"""Case metadata read from text as struct columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexanchor import vocab as V
from lexanchor.functions.text import capture, clean_name, col, first_nonempty, let, like, link_labels, links, norm_key, norm_spaces, plain_number

FIELDS = ["process_class", "process_number", "relator", "redator", "julgamento_data", "dje_data", "tema_rg", "sumula_num"]


def rapporteur_of(c) -> Column:
    """Rapporteur named in a metadata text."""
    return F.trim(capture(c, V.P_REL))


def judged_on(c) -> Column:
    """Date of judgment as a metadata text has it."""
    return F.trim(capture(c, V.P_JULG))


def extract_meta(c) -> Column:
    """Class, number, rapporteur, drafter, dates, theme and súmula of a metadata text ('' when absent)."""
    c = F.coalesce(col(c), F.lit(""))

    def fields(cited):
        cls = F.upper(capture(cited, V.P_PROC))
        sumula = F.when(cls == "", capture(c, V.P_SUMULA)).otherwise("")
        return F.struct(
            cls.alias("process_class"), plain_number(capture(cited, V.P_PROC, 2)).alias("process_number"),
            rapporteur_of(c).alias("relator"), F.trim(capture(c, V.P_RED)).alias("redator"),
            judged_on(c).alias("julgamento_data"), F.trim(capture(c, V.P_DJE)).alias("dje_data"),
            capture(c, V.P_TEMA).alias("tema_rg"),
            F.when(F.lower(c).contains("mula"), F.coalesce(F.nullif(capture(c, V.P_SV), F.lit("")), sumula)).otherwise("").alias("sumula_num"))

    return let(capture(c, V.P_PROC, 0), fields)


def extract_meta_strict(c) -> Column:
    """The stricter reading: separators required, number kept as written, no drafter."""
    c = norm_spaces(F.coalesce(col(c), F.lit("")))
    return F.struct(
        F.upper(capture(c, V.P_PROC_STRICT)).alias("process_class"), capture(c, V.P_PROC_STRICT, 2).alias("process_number"),
        F.trim(capture(c, V.P_REL_STRICT)).alias("relator"), F.trim(capture(c, V.P_JULG_STRICT)).alias("julgamento_data"),
        F.trim(capture(c, V.P_DJE_STRICT)).alias("dje_data"), F.trim(capture(c, V.P_TEMA_STRICT)).alias("tema_rg"),
        F.trim(capture(c, V.P_SV_STRICT)).alias("sumula_num"),
    )


def panel_of(c) -> Column:
    """'1ª T', 'Plenário', 'P' or ''."""
    whole, num = capture(c, V.P_TURMA, 0), capture(c, V.P_TURMA, 1)
    return (
        F.when(num != "", F.concat(num, F.lit("ª T"))).when(F.lower(whole).contains("plen"), "Plenário")
        .when(whole != "", "P").otherwise("")
    )


def merit_of(c) -> Column:
    return F.when(like(c, V.P_MERITO), "julgado").when(like(c, V.P_PENDENTE), "pendente").otherwise("")


def sumula_of(c, plain_source=None) -> Column:
    """struct(num, kind): a binding súmula wins over a plain one."""
    c = col(c)
    binding, plain = capture(c, V.P_SV), capture(c if plain_source is None else plain_source, V.P_SUMULA)
    return F.struct(
        F.when(binding != "", binding).otherwise(plain).alias("num"),
        F.when(binding != "", "vinculante").when(plain != "", "stf").otherwise("").alias("kind"),
    )


def detect_editorial(c, current=None) -> Column:
    """Editorial marker named in a text, else the one carried over."""
    t = F.lower(col(c))
    out = None
    for words, marker in V.MARKER_WORDS:
        hit = t.contains(words[0])
        for w in words[1:]:
            hit = hit | t.contains(w)
        out = F.when(hit, marker) if out is None else out.when(hit, marker)
    return out if current is None else out.otherwise(current)


def marker_line(c) -> Column:
    """Editorial marker of a marker line, NULL for other lines."""
    out = None
    for p, marker in V.MARKER_LINES:
        out = F.when(like(c, p), marker) if out is None else out.when(like(c, p), marker)
    return out


def is_marker_text(text) -> Column:
    """Short text that only announces an editorial layer."""
    t = F.lower(col(text))
    hint = t.contains(V.MARKER_HINTS[0])
    for w in V.MARKER_HINTS[1:]:
        hint = hint | t.contains(w)
    return (F.length(col(text)) < 80) & hint


def unit_type(marker, meta_text, cls, tema) -> Column:
    """Kind of decision unit; concentrated control keeps its own kind."""
    ed = F.lower(F.coalesce(col(marker), F.lit("")))
    return (
        F.when(F.coalesce(col(tema), F.lit("")) != "", "repercussao_geral")
        .when(ed.contains("sumula_vinculante") | F.coalesce(col(meta_text), F.lit("")).contains("Súmula Vinculante"), "sumula_vinculante")
        .when(ed.contains("sumula"), "sumula").when(ed.contains("controle_concentrado"), "controle_concentrado")
        .when(ed.contains("repercussao_geral"), "repercussao_geral")
        .when(ed.contains("julgados_correlatos") | ed.contains("julgado_correlato"), "julgado_correlato")
        .when(F.coalesce(col(cls), F.lit("")) != "", "julgado_principal").otherwise("comentario_editorial")
    )


def unit_type_main(marker, label, meta_text, cls, tema, sumula) -> Column:
    """Kind of decision unit; direct actions under concentrated control are main judgments."""
    ed = F.replace(norm_key(first_nonempty(marker, label, F.lit(" "))), F.lit("_"), F.lit(" "))
    c = F.coalesce(col(cls), F.lit(""))
    return (
        F.when((F.coalesce(col(sumula), F.lit("")) != "") | norm_key(F.coalesce(col(meta_text), F.lit(""))).contains("sumula vinculante")
               | ed.contains("sumula vinculante"), "sumula_vinculante")
        .when((F.coalesce(col(tema), F.lit("")) != "") | ed.contains("repercussao geral"), "repercussao_geral")
        .when(ed.contains("julgados correlatos") | ed.contains("julgado correlato"), "julgado_correlato")
        .when(ed.contains("controle concentrado"), F.when(c.isin("ADI", "ADC", "ADO", "ADPF"), "julgado_principal").otherwise("controle_concentrado"))
        .when(c != "", "julgado_principal").otherwise("comentario_editorial")
    )


REFERENCE_FIELDS = FIELDS[:7] + ["turma", "merito_status", "sumula_num", "sumula_tipo", "stf_incidente"]


def reference_meta(ref) -> Column:
    """Metadata of one bracket reference."""
    ref = col(ref)
    sum_ = sumula_of(ref)
    rel = clean_name(capture(ref, V.P_REL))
    has_rel = capture(ref, V.P_REL) != ""
    return F.struct(
        F.upper(capture(ref, V.P_PROC_LINKS)).alias("process_class"), plain_number(capture(ref, V.P_PROC_LINKS, 2)).alias("process_number"),
        F.when(has_rel, rel).otherwise(clean_name(capture(ref, V.P_VOTO))).alias("relator"),
        clean_name(capture(ref, V.P_RED)).alias("redator"), F.trim(capture(ref, V.P_JULG_LINKS)).alias("julgamento_data"),
        F.trim(F.coalesce(F.nullif(capture(ref, V.P_DJE_LINKS), F.lit("")), capture(ref, V.P_DJ))).alias("dje_data"),
        capture(ref, V.P_TEMA).alias("tema_rg"), panel_of(ref).alias("turma"), merit_of(ref).alias("merito_status"),
        sum_["num"].alias("sumula_num"), sum_["kind"].alias("sumula_tipo"),
    )


def first_in(refs, field: str) -> Column:
    """First non-empty value of a field over an array of structs."""
    hit = F.filter(F.transform(col(refs), lambda r: r[field]), lambda v: v != "")
    return F.coalesce(F.get(hit, F.lit(0)), F.lit(""))


def link_meta(html) -> Column:
    """Metadata carried by the links of a fragment; the last link with a value wins."""
    labels = F.array_join(link_labels(html), " ")

    def last(pattern):
        urls = links(html)
        hit = F.filter(F.transform(urls, lambda u: F.regexp_extract(u, pattern, 1)), lambda v: v != "")
        return F.coalesce(F.element_at(F.concat(F.array(F.lit("")), hit), -1), F.lit(""))

    return F.struct(
        F.upper(capture(labels, V.P_PROC_LINKS)).alias("process_class"), plain_number(capture(labels, V.P_PROC_LINKS, 2)).alias("process_number"),
        last(r"numeroTema=(\d+)").alias("tema_rg"), last(r"incidente=(\d+)").alias("stf_incidente"),
    )
