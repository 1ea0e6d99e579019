"""SQL fragments shared by the twins of text queries."""

from lexanchor import vocab as V


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(src: str, pattern: str, idx: int = 1) -> str:
    return f"regexp_extract({src}, {lit(pattern)}, {idx})"


def has(src: str, pattern: str) -> str:
    return f"regexp_matches({src}, {lit(pattern)})"


def sub(src: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({src}, {lit(pattern)}, {lit(to)}, 'g')"


def meta(src: str, p: str) -> str:
    """Columns p_process_class ... p_sumula_num read from a text."""
    src = f"coalesce({src}, '')"
    parts = {
        "process_class": f"upper({rx(src, V.P_PROC)})", "process_number": sub(rx(src, V.P_PROC, 2), "[.,]"),
        "relator": f"trim({rx(src, V.P_REL)})", "redator": f"trim({rx(src, V.P_RED)})", "julgamento_data": f"trim({rx(src, V.P_JULG)})",
        "dje_data": f"trim({rx(src, V.P_DJE)})", "tema_rg": rx(src, V.P_TEMA),
        "sumula_num": f"coalesce(nullif({rx(src, V.P_SV)}, ''), case when {rx(src, V.P_PROC)} = '' then {rx(src, V.P_SUMULA)} else '' end)",
    }
    return ", ".join(f"{e} as {p}_{c}" for c, e in parts.items())


def unit_type(marker: str, meta_text: str, cls: str, tema: str) -> str:
    return f"""case when coalesce({tema}, '') <> '' then 'repercussao_geral'
 when {marker} like '%sumula_vinculante%' or {meta_text} like '%Súmula Vinculante%' then 'sumula_vinculante'
 when {marker} like '%sumula%' then 'sumula' when {marker} like '%controle_concentrado%' then 'controle_concentrado'
 when {marker} like '%repercussao_geral%' then 'repercussao_geral'
 when {marker} like '%julgados_correlatos%' or {marker} like '%julgado_correlato%' then 'julgado_correlato'
 when coalesce({cls}, '') <> '' then 'julgado_principal' else 'comentario_editorial' end"""


def strip_accents(src: str) -> str:
    return f"translate({src}, {lit(V.ACCENTED)}, {lit(V.UNACCENTED)})"


def norm_spaces(src: str) -> str:
    return f"trim({sub(src, chr(92) + 's+', ' ')})"


def norm_key(src: str) -> str:
    return norm_spaces(f"translate(lower({strip_accents(norm_spaces(src))}), '–—', '--')")


def lower_slug(src: str) -> str:
    return f"regexp_replace(lower(trim(coalesce({src}, ''))), '^cf-art-', 'cf-1988-art-')"


_F = ["relator", "redator", "julgamento_data", "dje_data", "tema_rg", "sumula_num"]
RESOLVED = f"""rm as (select b.* exclude (editorial_label), {meta('metadata_text', 'm')}, {meta('block_text', 't')} from fx_blocks b),
rs0 as (select * exclude (process_class, process_number), case when m_relator <> '' then m_process_class else t_process_class end as xc,
 case when m_relator <> '' then m_process_number else t_process_number end as xn, process_class as oc, process_number as onum,
 {', '.join(f"case when m_relator <> '' then m_{f} else t_{f} end as {f}" for f in _F)} from rm),
rs1 as (select *, coalesce(nullif(xc, ''), oc) as process_class, coalesce(nullif(xn, ''), onum) as process_number from rs0),
rb as (select *, nullif(concat_ws('_', nullif(upper(process_class), ''), nullif(process_number, '')), '') as process_key,
 {unit_type('editorial_marker', 'metadata_text', 'process_class', 'tema_rg')} as decision_unit_type,
 substr(md5(anchor_slug||'|'||editorial_marker||'|'||block_text||'|'||metadata_text), 1, 16) as block_hash,
 case when anchor_slug like 'adct%' then 'adct' else 'cf' end as namespace,
 trim(process_class||' '||process_number||' rel. '||relator) as raw_signature from rs1)"""


def segment_agree(a: str, b: str) -> str:
    return f"({a} = {b} or starts_with({a}, {b}||'-') or starts_with({b}, {a}||'-'))"


UNIFIED = RESOLVED + f""",
un0 as (select r.* exclude (anchor_source), coalesce({lower_slug('p.anchor_slug')}, '') as parser_slug, coalesce({lower_slug('m.anchor_slug')}, '') as matcher_slug,
 coalesce(m.anchor_quality, '') as mq, coalesce(try_cast(m.anchor_confidence as double), 0.95) as mc
 from rb r left join fx_parser_anchors p on p.block_id = r.block_id left join fx_matcher_anchors m on m.block_id = r.block_id),
un1 as (select *, case when parser_slug <> '' and matcher_slug <> '' and AGREE then 'hybrid'
 when parser_slug <> '' and matcher_slug <> '' then 'position' when matcher_slug <> '' and mq <> 'unresolved' then 'text'
 when parser_slug <> '' then 'position' else 'unresolved' end as anchor_source from un0),
un as (select *, case anchor_source when 'hybrid' then case when length(matcher_slug) >= length(parser_slug) then matcher_slug else parser_slug end
  when 'text' then matcher_slug when 'position' then parser_slug else '' end as anchor_slug_final,
 round(case when anchor_source = 'hybrid' then 1.0 when parser_slug <> '' and matcher_slug <> '' then 0.85 when anchor_source = 'text' then mc
  when anchor_source = 'position' then 0.87 else 0.0 end::double, 3) as anchor_confidence_final from un1)"""
UNIFIED_LOOSE = UNIFIED.replace("AGREE", "(starts_with(matcher_slug, parser_slug) or starts_with(parser_slug, matcher_slug))")
UNIFIED = UNIFIED.replace("AGREE", segment_agree("matcher_slug", "parser_slug"))
ARTICLE = "try_cast(nullif(regexp_extract({c}, '-?art-([0-9]+)', 1), '') as int)"
