"""Surfaces: splitting a phrase into entity and facets, and classifying the entity. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators.lexicon import Lexicon

#: Characters stripped around an entity, and separators in the order in which they are tried.
EDGES = " -—:;."
SEPARATORS = ((":", "entity_colon_facet"), (" — ", "entity_dash_facet"), (" - ", "entity_dash_facet"), (". ", "entity_dot_facet"))
_GUESS = "struct<surface: string, facets: array<string>, generic: boolean, facet_only: boolean, confidence: double, pattern: string>"


def facets_of(normalized: Column, lexicon: Lexicon) -> Column:
    """The facets with a phrase in the text, in the lexicon's order."""
    return F.array_compact(F.array(*(F.when(X.any_phrase(normalized, phrases), F.lit(f)) for f, phrases in lexicon.facet_phrases().items())))


def is_generic(normalized: Column, lexicon: Lexicon) -> Column:
    return (normalized == "") | X.any_phrase(normalized, lexicon.generic())


def _guess(surface: Column, facets: Column | None, generic: Column | bool, facet_only: Column | bool, confidence: Column | float, pattern: Column | str | None) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        surface.alias("surface"), (facets if facets is not None else F.array().cast("array<string>")).alias("facets"), lit(generic).alias("generic"), lit(facet_only).alias("facet_only"),
        lit(confidence).cast("double").alias("confidence"), lit(pattern).cast("string").alias("pattern"),
    ).cast(_GUESS)


def _instruction(text: Column, low: Column, lexicon: Lexicon) -> Column:
    cases = [F.when(low.startswith(p + " "), _guess(X.strip_chars(F.substring(text, len(p) + 2, 1 << 20), EDGES), F.array(F.lit("instruction")), False, False, 0.80, "instruction_entity")) for p in lexicon.instruction_prefixes]
    if how := lexicon.how_to:
        shape = rf"(?iU)^({how['word']}\s+(?:{how['filler']}\s+)?({'|'.join(how['verbs'])})\s+).+$"
        lead = F.regexp_extract(low, shape, 1)
        facet = F.when(F.contains(F.regexp_extract(low, shape, 2), F.lit(how["dosage_verb"])), F.lit("dosage")).otherwise(F.lit("instruction"))
        entity = X.strip_chars(F.call_function("substring", text, F.length(lead) + 1), EDGES)
        cases.append(F.when(low.rlike(shape), _guess(entity, F.array(facet), False, False, 0.86, "how_to_entity")))
        cases.append(F.when(low.startswith(how["word"] + " "), _guess(text, F.array(F.lit("instruction")), True, True, 0.35, "how_to_generic")))
    return F.coalesce(*cases, F.lit(None).cast(_GUESS))


def _delimited(text: Column, lexicon: Lexicon) -> Column:
    def split(name: str):
        def halves(x: Column) -> Column:
            l_norm, r_norm = X.normalize_surface(x["left"]), X.normalize_surface(x["right"])
            right_facets, l_generic, r_generic = facets_of(r_norm, lexicon), is_generic(l_norm, lexicon), is_generic(r_norm, lexicon)
            behind = _guess(x["left"], right_facets, l_generic, False, 0.92, name)
            before = _guess(x["right"], facets_of(l_norm, lexicon), False, False, 0.82, "facet_left_entity_right")
            return F.when((F.size(right_facets) > 0) | r_generic, behind).when(l_generic, before)

        return halves

    cases = []
    for separator, name in SEPARATORS:
        at = F.instr(text, separator)
        left = X.strip(F.call_function("substring", text, F.lit(1), at - 1))
        right = X.strip(F.call_function("substring", text, at + len(separator)))
        guess = X.let(F.struct(left.alias("left"), right.alias("right")), split(name))
        cases.append(F.when((at > 0) & (left != "") & (right != ""), guess))
    return F.coalesce(*cases)


def _prefixed(text: Column, low: Column, lexicon: Lexicon) -> Column:
    held: dict[str, str] = {}
    for facet, phrases in lexicon.facet_phrases().items():
        held |= dict.fromkeys(phrases, facet)
    cases = []
    for phrase in sorted(held, key=len, reverse=True):
        entity = X.strip_chars(F.substring(text, len(phrase) + 1, 1 << 20), EDGES)
        cases.append(F.when(low.startswith(phrase + " ") & (entity != ""), _guess(entity, F.array(F.lit(held[phrase])), False, False, 0.72, "facet_entity_prefix")))
    return F.coalesce(*cases, F.lit(None).cast(_GUESS))


def core_surface(surface: Column, normalized: Column, lexicon: Lexicon) -> Column:
    """A drug's name without form and strength: what stands before the form, else before the first comma; other surfaces whole."""
    forms = lexicon.form_words()
    signal = X.any_phrase(normalized, forms) | strength(normalized, lexicon)
    tokens = F.split(surface, " ")
    bare = F.transform(tokens, lambda t: X.normalize_surface(F.rtrim(F.translate(t, ".", ","))))
    first = F.array_position(F.transform(bare, lambda t: t.isin(*forms) if forms else F.lit(False)), True)
    before_form = F.array_join(F.slice(tokens, F.lit(1), F.greatest(first - 1, F.lit(0)).cast("int")), " ")
    before_comma = X.strip(F.substring_index(surface, ",", 1))
    cut = F.when(first > 0, F.coalesce(F.nullif(before_form, F.lit("")), surface)).otherwise(F.coalesce(F.nullif(before_comma, F.lit("")), surface))
    return F.when(surface == "", F.lit(None).cast("string")).when(signal, cut).otherwise(surface)


def strength(normalized: Column, lexicon: Lexicon) -> Column:
    units = lexicon.unit_words()
    shapes = "|".join(rf"\Q{u}\E" if u else "" for u in units)
    return normalized.rlike(rf"(?U)\d+(?:[,.]\d+)?\s*(?:{shapes})\b") if units else F.lit(False)


def parse_surfaces(rows: DataFrame, value: str, lexicon: Lexicon) -> DataFrame:
    """Adds p_surface, p_normalized, p_core, p_normalized_core, p_facets, p_facet_type, p_generic, p_facet_only, p_confidence, p_pattern.

    Tried in order: instructions, delimiters, facet prefixes, and the phrase itself.
    """
    rows = rows.withColumn("_text", X.squeeze(X.strip_chars(X.strip_list_mark(X.or_empty(value)), " \t\r\n-—:;.")))
    rows = rows.withColumn("_low", X.normalize_surface(F.col("_text")))
    text, low = F.col("_text"), F.col("_low")
    own, generic = facets_of(low, lexicon), is_generic(low, lexicon)
    itself = _guess(text, own, generic, generic, F.when(F.size(own) > 0, 0.35).otherwise(0.0), F.when(generic, F.lit("generic_phrase")))
    empty = _guess(F.lit(""), None, True, True, 0.0, "empty")
    rows = rows.withColumn("_g", F.when(text == "", empty).otherwise(F.coalesce(_instruction(text, low, lexicon), _delimited(text, lexicon), _prefixed(text, low, lexicon), itself)))
    rows = rows.withColumn("p_surface", X.squeeze(X.strip_chars(F.col("_g.surface"), EDGES)))
    rows = rows.withColumn("p_normalized", X.normalize_surface(F.col("p_surface")))
    rows = rows.withColumn("p_core", core_surface(F.col("p_surface"), F.col("p_normalized"), lexicon))
    rows = rows.withColumn("p_normalized_core", X.normalize_surface(F.col("p_core")))
    given = F.array_distinct(F.col("_g.facets"))
    rows = rows.withColumn("p_facets", F.when(F.size(given) > 0, given).otherwise(facets_of(F.col("p_normalized"), lexicon)))
    rows = rows.withColumn("p_facet_type", F.try_element_at("p_facets", F.lit(1)))
    rows = rows.withColumn("p_generic", F.col("_g.generic") | is_generic(F.col("p_normalized"), lexicon))
    rows = rows.withColumn("p_facet_only", F.col("_g.facet_only") | (F.col("p_generic") & (F.col("p_surface") == "")))
    return rows.withColumn("p_confidence", F.col("_g.confidence")).withColumn("p_pattern", F.col("_g.pattern")).drop("_text", "_low", "_g")


def classify(rows: DataFrame, surface: str, lexicon: Lexicon) -> DataFrame:
    """Adds c_type, c_pattern, c_confidence: drug form and strength, drug pattern, then for each type keywords and patterns."""
    rows = rows.withColumn("_n", X.normalize_surface(X.or_empty(surface)))
    n = F.col("_n")

    def found(kind: str, pattern: Column | str, confidence: float) -> Column:
        return F.struct(F.lit(kind).alias("type"), (pattern if isinstance(pattern, Column) else F.lit(pattern)).alias("pattern"), F.lit(confidence).alias("confidence"))

    java = lambda p: "(?iU)" + p
    cases = [F.when(n == "", F.struct(F.lit("unknown").alias("type"), F.lit(None).cast("string").alias("pattern"), F.lit(0.0).alias("confidence")))]
    cases.append(F.when(X.any_phrase(n, lexicon.form_words()) & strength(n, lexicon), found("drug_product", "drug_form_strength", 0.92)))
    for kind in lexicon.entity_types:
        if kind == "drug_product":
            cases += [F.when(n.rlike(java(p)), found(kind, f"regex:{p}", 0.88)) for p in lexicon.patterns(kind)]
            continue
        words = lexicon.keywords(kind)
        if words:
            which = F.coalesce(*(F.when(X.any_phrase(n, [norm]), F.lit(f"keyword:{word}")) for word, norm in words))
            cases.append(F.when(X.any_phrase(n, [norm for _, norm in words]), found(kind, which, 0.78)))
        cases += [F.when(n.rlike(java(p)), found(kind, f"regex:{p}", 0.66)) for p in lexicon.patterns(kind)]
    rows = rows.withColumn("_c", F.coalesce(*cases, F.struct(F.lit("unknown").alias("type"), F.lit(None).cast("string").alias("pattern"), F.lit(0.25).alias("confidence"))))
    return rows.withColumn("c_type", F.col("_c.type")).withColumn("c_pattern", F.col("_c.pattern")).withColumn("c_confidence", F.col("_c.confidence")).drop("_n", "_c")
