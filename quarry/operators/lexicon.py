"""The lexicon that drives candidates: entity keywords and patterns, facets, generic phrases, drug forms, weights.

A Lexicon is data: the default one holds the fixed Russian medical values, tests and queries pass their own.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

import yaml

# Entity types in order of priority, with keywords and patterns; facets; generic phrases; forms and
# units; weights and thresholds.
DEFAULT = """
entity_types:
  drug_product:
    keywords: []
    regex: ['\\b[А-ЯЁA-Z][А-ЯЁа-яёA-Za-z0-9-]+(?:\\s+\\S+){0,8}\\s+\\d+(?:[,.]\\d+)?\\s*(?:мг|мкг|г|мл|%|ме)\\b']
  drug_brand:
    keywords: [зиннат, нурофен, парацетамол, ибупрофен, амоксиклав, супракс, сумамед]
  drug_substance:
    keywords: [цефуроксим, ибупрофен, парацетамол, амоксициллин, азитромицин]
  disease:
    keywords: [гастрит, грипп, орви, ангина, бронхит, пневмония, диабет, гипертония, астма, кариес]
    regex: ['\\b[а-яё-]*(?:ит|оз|ез|ома|патия)\\b', '\\bболезн[ьяи]\\b', '\\bинфекци[яи]\\b']
  symptom:
    keywords: [симптом, симптомы, боль, кашель, температура, тошнота, рвота, слабость, жалоба, признаки]
    regex: ['\\bсимптом\\w*(?:\\s+[A-ZА-ЯЁXx0-9][\\w-]*)?\\b']
  medical_device:
    keywords: [медицинские перчатки, перчатки, пульсоксиметр, спирометр, биоимпедансметр, анализатор, катетер, шприц, маска, аппарат]
    regex: ['\\bмедицинск\\w+\\s+перчат\\w+\\b']
  diagnostic_test:
    keywords: [общий анализ крови, анализ крови, анализ мочи, экг, узи, мрт, кт, спирометрия, пульсоксиметрия, биоимпедансметрия, обследование, диагностика, скрининг]
    regex: ['\\bанализ\\s+[а-яё\\s-]{3,60}\\b']
  procedure:
    keywords: [осмотр, обследование, измерение, вакцинация, прививка, регистрация, консультация, наблюдение]
  treatment:
    keywords: [лечение, терапия, прием препарата, схема приема, коррекция]
  anatomy:
    keywords: [желудок, сердце, кровь, легкие, кожа, слизистая, зуб, полость рта]
  contraindication:
    keywords: [противопоказание, противопоказания, ограничение, нельзя применять]
  adverse_effect:
    keywords: [побочные действия, нежелательные реакции, осложнение]
  document_type:
    keywords: [карта, форма, талон, приказ, регламент, отчетность, инструкция]
  medical_instruction:
    keywords: [как надевать, как использовать, инструкция по применению, алгоритм]
  healthcare_process:
    keywords: [центр здоровья, динамическое наблюдение, прием пациентов, работа центра, медицинская помощь]
  lifestyle_prevention:
    keywords: [профилактика, зож, питание, физическая активность, отказ от табака, грудное вскармливание]
  organization_process:
    keywords: [штатное расписание, организация работы, структура, отчетность, реестр]
  other_core_topic:
    keywords: [факторы риска, здоровье, пациент, ребенок]
facets:
  dosage: [дозировка, режим дозирования, способ применения, способы и дозировка, как принимать]
  administration: [особенности приема, способ приема, внутрь]
  contraindications: [противопоказания, нельзя применять]
  side_effects: [побочные действия, нежелательные реакции]
  symptoms: [симптомы, признаки]
  treatment: [лечение, терапия]
  diagnosis: [диагностика, анализ, обследование]
  preparation: [подготовка]
  instruction: [инструкция, как использовать, как надевать]
generic_phrases: [способы и дозировка, режим дозирования, особенности приема, инструкция по применению, показания, противопоказания, побочные действия, симптомы, лечение, диагностика, профилактика, подготовка, описание, общие сведения, введение]
forms: [таблетки, капсулы, раствор, суспензия, мазь, крем, капли, спрей, сироп, порошок, гель]
strength_units: [мг, мкг, г, мл, "%", ме]
instruction_prefixes: [инструкция по применению, инструкция по использованию]
how_to: {word: как, filler: правильно, verbs: [надевать, использовать, применять, принимать, подготовить, подготовиться], dosage_verb: принимать}
treatment_verb: {pattern: '\\bлеч\\w+\\b', surface: лечение}
conditional_words: [если, при наличии, при отсутствии, только если, отсутствует]
scoring:
  minimum_score: 0.05
  primary_min_score: 0.75
  section_min_score: 0.45
  secondary_min_score: 0.32
  needs_review_score: 0.55
  components: {title_entity_match: 0.26, heading_entity_match: 0.22, heading_path_match: 0.10, topic_unit_position: 0.08, entity_pattern_match: 0.20, facet_split_confidence: 0.08, frequency_in_headings: 0.08, frequency_in_unit_text: 0.06, cross_reference_signal: 0.07, base_entity: 0.18, base_generic_facet: 0.16, generic_penalty: -0.30, dosage_only_penalty: -0.16, too_short_penalty: -0.18}
review: {top_k: 10, sample_size: 300, many_units: 50, many_candidates: 50, explosion: 200}
"""
#: Types mined from running text by pattern as well as by keyword, and the shortest keyword mined.
MINED_PATTERN_TYPES = ("drug_product", "symptom", "medical_device")
LEAST_MINED_KEYWORD = 4


#: The files of a configuration folder, where it stands under a project, and the keys of review.yaml.
FOLDER_FILES = ("drug_forms.yaml", "entity_patterns.yaml", "facet_patterns.yaml", "generic_blocklist.yaml", "review.yaml", "scoring.yaml")
FOLDER = ("configs", "tagging")
REVIEW_KEYS = {
    "review_top_k_per_doc": "top_k", "review_sample_size": "sample_size", "large_doc_topic_unit_warning_threshold": "many_units",
    "many_candidates_warning_threshold": "many_candidates", "candidate_explosion_warning_threshold": "explosion",
}


def find_folder(root: str) -> str | None:
    """The configuration folder of a project, or else of the working directory."""
    return next((p for p in (os.path.join(r, *FOLDER) for r in (root, os.getcwd())) if os.path.isdir(p)), None)


def _norm(value: str) -> str:
    """normalize_surface of a lexicon phrase, in Python: the same form that columns are brought to."""
    import re

    low = re.sub(r"^[\W_]+|[\W_]+$", "", " ".join(value.split()).lower().replace("ё", "е"))
    return " ".join(re.sub(r"\s*([:;,.])\s*", r"\1 ", low).split())


@dataclass(frozen=True)
class Lexicon:
    entity_types: dict
    facets: dict
    generic_phrases: list
    forms: list = field(default_factory=list)
    strength_units: list = field(default_factory=list)
    instruction_prefixes: list = field(default_factory=list)
    how_to: dict = field(default_factory=dict)
    treatment_verb: dict = field(default_factory=dict)
    conditional_words: list = field(default_factory=list)
    scoring: dict = field(default_factory=dict)
    review: dict = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str) -> Lexicon:
        return cls(**yaml.safe_load(text))

    @classmethod
    def read(cls, path: str) -> Lexicon:
        with open(path, encoding="utf-8") as f:
            return cls.parse(f.read())

    @classmethod
    def read_folder(cls, folder: str) -> Lexicon:
        """The six files of a configuration folder under their own key names; a file or key that is absent keeps its default."""
        held = {}
        for name in FOLDER_FILES:
            path = os.path.join(folder, name)
            if os.path.exists(path):
                with open(path, encoding="utf-8") as f:
                    held[name] = yaml.safe_load(f) or {}
        base = default()
        given = {k: v for name, found in held.items() if name not in ("scoring.yaml", "review.yaml") for k, v in found.items() if k in cls.__dataclass_fields__}
        review = base.review | {REVIEW_KEYS[k]: v for k, v in held.get("review.yaml", {}).items() if k in REVIEW_KEYS}
        return replace(base, **given, scoring=base.scoring | held.get("scoring.yaml", {}), review=review)

    def with_defaults(self) -> Lexicon:
        base = default()
        return Lexicon(**{k: getattr(self, k) or getattr(base, k) if k in ("scoring", "review") else getattr(self, k) for k in self.__dataclass_fields__})

    def keywords(self, kind: str) -> list[tuple[str, str]]:
        """(keyword, normalised) of a type, in order."""
        return [(k, _norm(k)) for k in self.entity_types[kind].get("keywords") or [] if _norm(k)]

    def patterns(self, kind: str) -> list[str]:
        return self.entity_types[kind].get("regex") or []

    def facet_phrases(self) -> dict[str, list[str]]:
        return {f: [_norm(p) for p in phrases if _norm(p)] for f, phrases in self.facets.items()}

    def generic(self) -> list[str]:
        return [_norm(p) for p in self.generic_phrases]

    def form_words(self) -> list[str]:
        return [_norm(p) for p in self.forms]

    def unit_words(self) -> list[str]:
        return [_norm(p) for p in self.strength_units]


def default() -> Lexicon:
    return Lexicon.parse(DEFAULT)
