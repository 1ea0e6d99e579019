"""Text functions as column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexanchor import vocab as V


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: What stands in front of any class and number: two to four letters, then a digit. One look ahead spares most words the list of classes.
_CLASSES = [(rf"(?i)\b({c})\s*[\-n.\s]*([\d]", rf"(?i)\b(?=[a-z]{{2,4}}[\-n.\s]*\d)({c})\s*[\-n.\s]*([\d]") for c in (V.CLASSES, V.CLASSES_LINKS)]


def pat(p: str) -> str:
    """Pattern as Java reads it: Unicode case folding where it has letters beyond ASCII, a look ahead where it lists process classes."""
    for plain, guarded in _CLASSES:
        p = p.replace(plain, guarded)
    return p if p.isascii() else p.replace("(?i)", "(?iu)")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def like(c, pattern: str) -> Column:
    return col(c).rlike(pat(pattern))


def capture(c, pattern: str, idx: int = 1) -> Column:
    """Capture of the first match, '' when there is none."""
    return F.regexp_extract(col(c), pat(pattern), idx)


def group(c, pattern: str, idx: int = 1) -> Column:
    """Capture of the first match, NULL when there is none or it is empty."""
    return F.nullif(capture(c, pattern, idx), F.lit(""))


def first_nonempty(*cols) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def norm_spaces(c) -> Column:
    return F.trim(F.regexp_replace(col(c), r"[\s ]+", " "))


def strip_accents(c) -> Column:
    return F.translate(col(c), V.ACCENTED, V.UNACCENTED)


def norm_key(c, collapsed: bool = False) -> Column:
    """Space-collapsed, accent-free, lower-case key with plain dashes; of ``norm_spaces(c)`` if ``collapsed``."""
    return F.lower(F.translate(col(c) if collapsed else norm_spaces(c), V.ACCENTED + "–—", V.UNACCENTED + "--"))


def _where(c, part: str, change) -> Column:
    """``change(text)`` where the text contains ``part``, else the text as it is: most texts need no pattern."""
    return let(col(c), lambda t: F.when(t.contains(part), change(t)).otherwise(t))


def _no_tags(c) -> Column:
    return _where(c, "<", lambda t: F.regexp_replace(t, r"<[^>]+>", " "))


def _no_markup(c) -> Column:
    return _where(_no_tags(c), "&", lambda t: F.regexp_replace(t, r"&[a-z]+;|&#\d+;", " "))


def folded_text(c) -> Column:
    """Lower-case text without markup and accents, from which the two keys below are made."""
    return F.lower(strip_accents(_no_markup(c)))


def ascii_key(c, size: int = 80, folded: bool = False) -> Column:
    """Alphanumeric comparison key; editorial prefix removed after trimming."""
    plain = F.trim(col(c) if folded else folded_text(c))
    return F.substring(F.regexp_replace(F.regexp_replace(plain, V.ASCII_KEY_PREFIX, ""), "[^a-z0-9]", ""), 1, size)


def word_key(c, prefixes: bool = True, folded: bool = False) -> Column:
    """Words separated by one space, no markup, accents or punctuation."""
    key = F.trim(F.regexp_replace(col(c) if folded else folded_text(c), r"[^\p{L}\p{N}_]+", " "))
    if not prefixes:
        return key
    # every listed prefix is optional and tried once, in order
    return F.regexp_replace(key, "^" + "".join(f"(?:{p} ?)?" for p in V.WORD_KEY_PREFIXES), "")


def boundary_key(c) -> Column:
    """Lower-case text without markup, spaces collapsed."""
    return F.lower(F.trim(F.regexp_replace(_no_markup(c), r"\s+", " ")))


def decode_numeric_entities(c) -> Column:
    codes = F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"&#(\d{1,7});"), F.lit(1)))

    def one(acc, code):
        char = F.decode(F.unhex(F.lpad(F.conv(code, 10, 16), 8, "0")), "UTF-32")
        return F.replace(acc, F.concat(F.lit("&#"), code, F.lit(";")), char)

    return F.aggregate(codes, col(c), one)


def strip_html(c) -> Column:
    """Text of an HTML fragment: tags out, entities decoded, spaces collapsed."""

    def decoded(t):
        for name, char in V.ENTITIES:
            t = F.replace(t, F.lit(name), F.lit(char))
        return _where(F.regexp_replace(t, r"&[a-z]+;", ""), "&#", decode_numeric_entities)

    return norm_spaces(_where(_no_tags(c), "&", decoded))


def strip_prefix(c, prefixes=tuple(V.EDITORIAL_PREFIXES)) -> Column:
    """Text after the first listed prefix that starts it."""
    return F.regexp_replace(col(c), "^(?:" + "|".join(prefixes) + r")\s*", "")


def split_metadata(c) -> Column:
    """struct(text, meta): a trailing bracket of ten or more characters is metadata."""
    c = col(c)
    meta = F.regexp_extract(c, V.P_BRACKET_END, 1)
    return F.struct(
        F.trim(F.regexp_replace(c, V.P_BRACKET_END, "")).alias("text"), F.trim(meta).alias("meta")
    )


# ------------------------------------------------------------------- numerals
_VALUES = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def roman_to_int(c) -> Column:
    """Value of a Roman numeral: letters add up, a letter before a larger one counts negative."""
    up = F.upper(col(c))
    letters = list(_VALUES)
    total = F.lit(0)
    for i, ch in enumerate(letters):
        total = total + F.regexp_count(up, F.lit(ch)) * _VALUES[ch]
        if i + 1 < len(letters):
            smaller = F.regexp_count(up, F.lit(f"{ch}(?=[{''.join(letters[i + 1:])}])"))
            total = total - smaller * (2 * _VALUES[ch])
    return F.when(up.rlike("^[IVXLCDM]+$"), total).cast("int")


def int_to_roman(c) -> Column:
    """Roman numeral of a positive integer, by decimal place."""
    n = col(c).cast("int")

    def place(ten: str, five: str, one: str, unit: int) -> Column:
        digit = F.floor(n / unit) % 10
        forms = ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten]
        return F.element_at(F.array(*[F.lit(x) for x in forms]), (digit + 1).cast("int"))

    thousands = F.repeat(F.lit("M"), F.floor(n / 1000).cast("int"))
    return F.when(
        n > 0, F.concat(thousands, place("M", "D", "C", 100), place("C", "L", "X", 10), place("X", "V", "I", 1))
    )


# ---------------------------------------------------------------------- slugs
def norm_slug(c) -> Column:
    """Canonical prefix and arabic inciso number."""
    s = F.regexp_replace(col(c), "^cf-art-", "cf-1988-art-")
    roman = F.regexp_extract(s, r"(?i)-inc-([IVXLCDM]+)(?:-|$)", 1)
    arabic = F.regexp_replace(s, r"(?i)-inc-[IVXLCDM]+(?=-|$)", F.concat(F.lit("-inc-"), roman_to_int(roman).cast("string")))
    return F.when(roman != "", arabic).otherwise(s)


def lower_slug(c) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(col(c), F.lit("")))), "^cf-art-", "cf-1988-art-")


def build_slug(ns, art, par=None, inc=None, ali=None) -> Column:
    """cf-1988-art-N / adct-art-N with the sub-device segments that are present."""
    out = F.concat(F.when(col(ns) == "adct", "adct").otherwise("cf-1988"), F.lit("-art-"), col(art).cast("string"))
    for tag, part in [("par", par), ("inc", inc), ("ali", ali)]:
        if part is not None:
            seg = F.nullif(col(part).cast("string"), F.lit(""))
            out = F.concat(out, F.coalesce(F.concat(F.lit(f"-{tag}-"), seg), F.lit("")))
    return out


def article_of(c) -> Column:
    return group(c, r"^cf-1988-art-(\d+)").try_cast("int")


def parse_slug(c) -> Column:
    """struct(namespace, article, depth, has_par, has_inc, has_ali)."""
    c = col(c)
    has = {t: c.contains(f"-{t}-") for t in ("par", "inc", "ali")}
    depth = (
        F.when(has["ali"], "alinea").when(has["inc"], "inciso").when(has["par"], "paragrafo")
        .when(c.rlike("^(cf-1988|adct)-art-"), "artigo").otherwise("outro")
    )
    return F.struct(
        F.when(c.startswith("adct"), "adct").otherwise("cf").alias("namespace"),
        group(c, r"-?art-(\d+)").try_cast("int").alias("article"), depth.alias("depth"),
        has["par"].alias("has_par"), has["inc"].alias("has_inc"), has["ali"].alias("has_ali"),
    )


def move_slug(c, article) -> Column:
    """Same slug under another article, sub-device suffix kept."""
    return F.concat(F.lit("cf-1988-art-"), col(article).cast("string"), F.regexp_replace(col(c), r"^cf-1988-art-\d+", ""))


# ---------------------------------------------------------- dates and numbers
def norm_date(c, first_year: int = 1988, last_year: int = 2026) -> Column:
    """D-M-YYYY to ISO text; NULL outside the valid window or when malformed."""
    def parts(t):
        return F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.transform(F.split(t, "-"), lambda n: n.cast("int")))

    def iso(n):
        ok = n[0].between(1, 31) & n[1].between(1, 12) & n[2].between(first_year, last_year)
        return F.when(ok, F.format_string("%04d-%02d-%02d", n[2], n[1], n[0]))

    return let(let(F.trim(col(c)), parts), iso)


def judgment_year(c) -> Column:
    return group(c, V.P_YEAR).try_cast("int")


def digits(c) -> Column:
    return F.regexp_replace(col(c), r"[^\d]", "")


def plain_number(c) -> Column:
    """Process number without thousand separators."""
    return F.regexp_replace(col(c), "[.,]", "")


def process_key(cls, num) -> Column:
    """CLASS_NUMBER, or whichever part is there, or NULL."""
    k = F.nullif(F.upper(F.trim(F.coalesce(col(cls), F.lit("")))), F.lit(""))
    n = F.nullif(F.regexp_replace(F.trim(F.coalesce(col(num), F.lit(""))), r"\.+$", ""), F.lit(""))
    return F.nullif(F.concat_ws("_", k, n), F.lit(""))


def process_key_with_sumula(cls, num, sumula) -> Column:
    k = F.nullif(F.upper(F.trim(F.coalesce(col(cls), F.lit("")))), F.lit(""))
    n = F.nullif(digits(F.coalesce(col(num), F.lit(""))), F.lit(""))
    s = F.nullif(col(sumula), F.lit(""))
    return F.coalesce(F.concat(k, F.lit("_"), n), F.concat(F.lit("SUMULA_VINCULANTE_"), digits(s)), F.lit(""))


# ------------------------------------------------------------ hashes and labels
def block_hash_md5(slug, marker, text, meta) -> Column:
    """First 16 hex digits over slug, marker and the whole text and metadata."""
    raw = F.concat_ws("|", *[F.coalesce(col(c), F.lit("")) for c in (slug, marker, text, meta)])
    return F.substring(F.md5(raw), 1, 16)


def block_hash_sha(*parts) -> Column:
    return F.sha2(F.concat_ws("||", *[norm_spaces(F.coalesce(col(p), F.lit(""))) for p in parts]), 256)


def marker_label(c) -> Column:
    return F.initcap(F.replace(F.coalesce(col(c), F.lit("")), F.lit("_"), F.lit(" ")))


def raw_signature(cls, num, name) -> Column:
    e = [F.coalesce(col(x), F.lit("")) for x in (cls, num, name)]
    return F.trim(F.concat(e[0], F.lit(" "), e[1], F.lit(" rel. "), e[2]))


# ----------------------------------------------------------------------- names
def _alias(c: Column, aliases: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.element_at(table, c), c)


def clean_name(c, aliases=V.EXTRACT_ALIASES) -> Column:
    """Extracted person name: cut at brackets, four words at most, aliases applied; '' when too short."""
    s = F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))), r"[.\-),;]+$", "")
    s = F.trim(F.regexp_extract(s, r"^([^;(\[{]*)", 1))
    s = _alias(F.regexp_extract(s, r"^(\S+(?:\s+\S+){0,3})", 1), aliases)
    return F.regexp_extract(s, r"^.{4,}$", 0)


def canonical_name(c, aliases=V.NAME_ALIASES) -> Column:
    """Canonical person name; trailing junk is cut from long or bracketed values."""
    s = _alias(col(c), aliases)
    junk = s.contains("(") | s.contains(";") | (F.length(s) > 30)
    head = F.regexp_extract(s, V.P_NAME_HEAD, 1)
    return F.when(junk & (head != ""), F.trim(head)).otherwise(s)


# ------------------------------------------------------------------------ links
def url_params(c) -> Column:
    """struct(processo, classe, incidente, tema, peca, kind) read from a link."""
    u = F.replace(col(c), F.lit("&amp;"), F.lit("&"))
    proc, inc = F.regexp_extract(u, r"PROCESSO=(\d+)", 1), F.regexp_extract(u, r"incidente=(\d+)", 1)
    piece = F.regexp_extract(u, r"downloadPeca.*?id=(\d+)", 1)
    return F.struct(
        proc.alias("processo"), F.replace(F.regexp_extract(u, r"CLASSE=([^&]+)", 1), F.lit("%2D"), F.lit("-")).alias("classe"),
        inc.alias("incidente"), F.regexp_extract(u, r"numeroTema=(\d+)", 1).alias("tema"), piece.alias("peca"),
        F.when(proc != "", "processo").when(inc != "", "detalhe").when(piece != "", "peca").otherwise("").alias("kind"),
    )


def links(c) -> Column:
    return F.regexp_extract_all(col(c), F.lit(r'href="([^"]+)"'), F.lit(1))


def link_labels(c) -> Column:
    return F.transform(F.regexp_extract_all(col(c), F.lit(r"(?s)<a[^>]*>(.*?)</a>"), F.lit(1)), strip_html)


def link_summary(c) -> Column:
    """struct(first, all, labels) of the links in a fragment."""
    return F.struct(
        F.coalesce(F.get(links(c), F.lit(0)), F.lit("")).alias("first"), F.array_join(links(c), " | ").alias("all"),
        F.array_join(link_labels(c), " | ").alias("labels"),
    )


# ---------------------------------------------------------------------- vectors
def pieces_for_model(c, limit: int = 24000) -> Column:
    """Embedding inputs of one text: consecutive pieces of at most ``limit`` characters, one at least."""
    text = F.coalesce(col(c), F.lit(""))
    last = F.greatest(F.floor((F.length(text) - 1) / limit), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(text, i * limit + 1, F.lit(limit)))


def token_estimate(c) -> Column:
    return F.ceil(F.length(col(c)) / 4).cast("int")


def vector_literal(c) -> Column:
    """'[v1,v2,...]' with seven decimals, ties to even, sign of a negative zero kept."""
    unit = 10**7

    def one(v):
        n = F.abs((F.bround(v.cast("double").cast("decimal(38,26)"), 7) * unit).cast("bigint"))
        whole, part = F.floor(n / unit).cast("string"), F.lpad((n % unit).cast("string"), 7, "0")
        return F.concat(F.when(v < 0, "-").otherwise(""), whole, F.lit("."), part)

    return F.concat(F.lit("["), F.array_join(F.transform(col(c), one), ","), F.lit("]"))


def dot(a, b) -> Column:
    """Inner product in double precision."""
    pairs = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def cosine(a, b) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


# ------------------------------------------------------------------------- JSON
def jget(c, key: str) -> Column:
    return F.get_json_object(col(c), f"$.{key}")


def jhas(c, key: str) -> Column:
    """Key is present, even when its value is null."""
    return F.coalesce(F.array_contains(F.json_object_keys(col(c)), key), F.lit(False))
