"""Values that must agree with the published indicators for results to be comparable."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: outcome definitions ------------------------------------------------
# (section, id, label, code ranges, data sources)
OUTCOMES = [
    ("respiratory", "resp_all", "Todas as doenças respiratórias", ["J00-J99"], ["SIH", "SIM"]),
    ("respiratory", "pneumonia", "Pneumonias", ["J12-J18"], ["SIH", "SIM"]),
    ("respiratory", "acute_bronchitis_bronchiolitis", "Bronquite e bronquiolite agudas", ["J20-J21"], ["SIH", "SIM"]),
    ("respiratory", "copd", "Bronquite crônica, enfisema e DPOC", ["J40-J44"], ["SIH", "SIM"]),
    ("respiratory", "asthma", "Asma e estado de mal asmático", ["J45-J46"], ["SIH", "SIM"]),
    ("respiratory", "pneumoconiosis", "Pneumoconioses", ["J60-J65"], ["SIH", "SIM"]),
    ("respiratory", "covid19", "Covid-19", ["U071", "U072"], ["SIH", "SIM", "SIVEP"]),
    ("respiratory", "srag", "Síndrome Respiratória Aguda Grave", [], ["SIVEP"]),
    ("respiratory", "influenza", "Influenza", ["J09-J11"], ["SIVEP", "SIH", "SIM"]),
    ("cardiovascular", "cardio_all", "Todas as doenças do aparelho circulatório", ["I00-I99"], ["SIH", "SIM"]),
    ("cardiovascular", "hypertension", "Doenças hipertensivas", ["I10-I15"], ["SIH", "SIM"]),
    ("cardiovascular", "ischemic_heart_disease", "Doenças isquêmicas do coração", ["I20-I25"], ["SIH", "SIM"]),
    ("cardiovascular", "acute_myocardial_infarction", "Infarto agudo do miocárdio", ["I21-I22"], ["SIH", "SIM"]),
    ("cardiovascular", "pulmonary_embolism", "Embolia pulmonar", ["I26"], ["SIH", "SIM"]),
    ("cardiovascular", "cardiac_arrhythmia", "Transtornos de condução e arritmias cardíacas", ["I44-I49"], ["SIH", "SIM"]),
    ("cardiovascular", "heart_failure", "Insuficiência cardíaca", ["I50"], ["SIH", "SIM"]),
    ("cardiovascular", "cerebrovascular", "Doenças cerebrovasculares", ["I60-I69"], ["SIH", "SIM"]),
    ("cardiorespiratory", "cardiorespiratory_all", "Todas as doenças cardiorrespiratórias", ["I00-I99", "J00-J99"], ["SIH", "SIM"]),
    ("cancer", "all_malignant_neoplasms", "Todas as neoplasias malignas", ["C00-C97"], ["SIM", "RHC", "Painel Oncologia"]),
    ("cancer", "lung", "Traqueia, brônquios e pulmão", ["C33-C34"], ["SIM", "RHC"]),
    ("cancer", "bladder", "Bexiga", ["C67"], ["SIM", "RHC"]),
    ("cancer", "non_hodgkin_lymphoma", "Linfoma não Hodgkin", ["C82-C86"], ["SIM", "RHC"]),
    ("cancer", "multiple_myeloma", "Mieloma múltiplo", ["C90"], ["SIM", "RHC"]),
    ("cancer", "leukemia", "Leucemias", ["C91-C95"], ["SIM", "RHC"]),
    ("cancer", "myelodysplastic_syndromes", "Síndromes mielodisplásicas", ["D46"], ["SIM", "RHC"]),
    ("cancer", "colorectal", "Cólon e reto", ["C18-C21"], ["SIM", "RHC", "Painel Oncologia"]),
    ("cancer", "stomach", "Estômago", ["C16"], ["SIM", "RHC"]),
    ("cancer", "liver", "Fígado", ["C22"], ["SIM", "RHC"]),
    ("cancer", "pancreas", "Pâncreas", ["C25"], ["SIM", "RHC"]),
    ("cancer", "breast", "Mama", ["C50"], ["SIM", "RHC", "SISCAN", "Painel Oncologia"]),
    ("cancer", "cervix", "Colo do útero", ["C53"], ["SIM", "RHC", "SISCAN", "Painel Oncologia"]),
    ("cancer", "prostate", "Próstata", ["C61"], ["SIM", "RHC", "Painel Oncologia"]),
    ("neurological", "alzheimer", "Doença de Alzheimer", ["G30", "F00.0-F00.2"], ["SIM", "SIH", "SIA"]),
    ("neurological", "dementias_all", "Doença de Alzheimer e outras demências", ["G30", "F00-F03"], ["SIM", "SIH", "SIA"]),
]

# --- Fixed values: analysis periods ---------------------------------------------------
# (section, id, first month, last month, status)
PERIODS = [
    ("respiratory", "resp_2008_2014", "2008-01", "2014-12", "definitive_or_source_specific"),
    ("respiratory", "resp_2015_2019", "2015-01", "2019-12", "definitive_or_source_specific"),
    ("respiratory", "resp_2020_2021", "2020-01", "2021-12", "pandemic"),
    ("respiratory", "resp_2022", "2022-01", "2022-12", "post_acute_pandemic"),
    ("respiratory", "resp_2023_2024", "2023-01", "2024-12", "definitive_or_source_specific"),
    ("respiratory", "resp_2025_2026", "2025-01", "2026-12", "provisional"),
    ("cardiovascular", "cardio_2008_2019", "2008-01", "2019-12", "definitive_or_source_specific"),
    ("cardiovascular", "cardio_2020_2021", "2020-01", "2021-12", "pandemic_context"),
    ("cardiovascular", "cardio_2022_2024", "2022-01", "2024-12", "definitive_or_source_specific"),
    ("cardiovascular", "cardio_2025_2026", "2025-01", "2026-12", "provisional"),
    ("cardiorespiratory", "cardioresp_2008_2019", "2008-01", "2019-12", "definitive_or_source_specific"),
    ("cardiorespiratory", "cardioresp_2020_2021", "2020-01", "2021-12", "pandemic_context"),
    ("cardiorespiratory", "cardioresp_2022_2024", "2022-01", "2024-12", "definitive_or_source_specific"),
    ("cardiorespiratory", "cardioresp_2025_2026", "2025-01", "2026-12", "provisional"),
    ("cancer", "cancer_2010_2014", "2010-01", "2014-12", "five_year_period"),
    ("cancer", "cancer_2015_2019", "2015-01", "2019-12", "five_year_period"),
    ("cancer", "cancer_2020_2021", "2020-01", "2021-12", "care_disruption"),
    ("cancer", "cancer_2022_2024", "2022-01", "2024-12", "post_disruption_and_oncology_line"),
    ("cancer", "cancer_2025_onward", "2025-01", "2099-12", "provisional_prevenir_50_plus"),
]
# Dates at which series may break: (id, month).
BREAKS = [
    ("respiratory_pandemic_start", "2020-03"),
    ("cancer_care_disruption_start", "2020-01"),
    ("cancer_care_disruption_end", "2022-12"),
    ("oncology_line_start", "2022-03"),
    ("prevenir_50_plus_start", "2025-01"),
]
PANDEMIC_START = "2020-03-01"
INTERRUPTION_ORIGIN_YEAR = 2008

# --- Fixed values: year labels by product ---------------------------------------------
# (product, first year, last year, label); years outside every range get the default.
PRODUCT_PERIOD_STATUS = [
    ("annual_admissions", 2025, 2025, "provisional_2025"),
    ("monthly_notifications", 2026, 2026, "provisional_partial_2026"),
    ("monthly_notifications", 2025, 2025, "provisional_2025"),
    ("interrupted_series", 2025, 2025, "provisional_2025"),
    ("registry", 2013, 2019, "observed_pre_disruption"),
    ("registry", 2020, 2022, "cancer_care_disruption"),
    ("registry", 2023, 2024, "observed_post_disruption"),
    ("neurological", 2025, 9999, "neurological_provisional"),
    ("municipal_admissions", 2025, 9999, "provisional"),
    ("ambulatory", 2025, 9999, "provisional"),
]
PRODUCT_PERIOD_DEFAULT = {
    "annual_admissions": "complete_annual",
    "monthly_notifications": "surveillance_versioned",
    "interrupted_series": "eligible_complete_year",
    "registry": "source_year_observed",
    "neurological": "source_year_observed",
    "municipal_admissions": "source_year_observed",
    "ambulatory": "source_year_observed",
}
# (section, first year, last year, label) for death rates.
SECTION_PERIOD_STATUS = [
    ("cancer", 2020, 2022, "cancer_care_disruption"),
    ("cancer", 2025, 9999, "cancer_provisional_prevenir_50_plus"),
    ("respiratory", 2020, 2021, "respiratory_pandemic"),
    ("respiratory", 2025, 9999, "respiratory_provisional"),
    ("cardiovascular", 2020, 2021, "cardiovascular_pandemic_context"),
    ("cardiovascular", 2025, 9999, "cardiovascular_provisional"),
    ("cardiorespiratory", 2020, 2021, "cardiorespiratory_pandemic_context"),
    ("cardiorespiratory", 2025, 9999, "cardiorespiratory_provisional"),
]
SECTION_PERIOD_DEFAULT = "source_year_observed"

# --- Fixed values: demographic labels -------------------------------------------------
AGE_GROUPS = ["<1", "1-4", "5-14", "15-24", "25-44", "45-64", "65-74", "75+"]
AGE_STARTS = [0, 1, 5, 15, 25, 45, 65, 75]
SEXES = ["masculino", "feminino"]
UNKNOWN = "ignorado"
DEATH_SEX_CODES = {"1": "masculino", "2": "feminino"}
NOTIFICATION_SEX_CODES = {"M": "masculino", "F": "feminino"}
NOTIFICATION_STATUS = {
    "1": "recuperado",
    "2": "óbito por SRAG",
    "3": "óbito por outra causa",
    "9": "ignorado",
    "": "sem informação",
}
STATUS_MISSING = "sem informação"
DEATH_UNIT = "óbito de residente no SIM; causa básica"
NOTIFICATION_UNIT = "notificação de SRAG de residente; vigilância, não incidência"
STATUS_DEATH = "óbito"
# (outcome id, label, final classification code or None for every notification)
NOTIFICATION_OUTCOMES = [
    ("srag", "Síndrome Respiratória Aguda Grave", None),
    ("influenza", "SRAG por influenza", "1"),
    ("covid19", "SRAG por Covid-19", "5"),
]
SEX_NOT_APPLICABLE = [("cervix", "masculino"), ("prostate", "feminino")]

# --- Fixed values: geography labels ---------------------------------------------------
SELECTED = "volta_redonda"
REST_OF_STATE = "rest_of_rj_excluding_vr"
STATE_TOTAL = "rj_total"
REST_OF_COUNTRY = "rest_of_brazil_excluding_rj"
COUNTRY_TOTAL = "brazil_total"
OUTSIDE_COUNTRY = "outside_brazil"
OUTSIDE_STATE = "outside_rj"

# --- Fixed values: census age and sex category codes ----------------------------------
CENSUS_YEAR = "2022"
CENSUS_VARIABLE = "93"
CENSUS_AGE_DECLARATION = "113635"
CENSUS_SEX = {"4": "masculino", "5": "feminino"}
CENSUS_AGE = {
    "6557": "<1",
    "6558": "1-4", "6559": "1-4", "6560": "1-4", "6561": "1-4",
    "93084": "5-14", "93085": "5-14",
    "93086": "15-24", "93087": "15-24",
    "93088": "25-44", "93089": "25-44", "93090": "25-44", "93091": "25-44",
    "93092": "45-64", "93093": "45-64", "93094": "45-64", "93095": "45-64",
    "93096": "65-74", "93097": "65-74",
    "93098": "75+", "49108": "75+", "49109": "75+", "60040": "75+", "60041": "75+", "6653": "75+",
}

# --- Fixed values: raw file layouts ---------------------------------------------------
DEATH_REQUIRED = ["CODMUNRES", "SEXO", "IDADE", "CAUSABAS"]
DEATH_OPTIONAL = ["CODMUNOCOR", "CAUSAMAT", "DTOBITO", "DTNASC", "TIPOBITO", "STDOEPIDEM"]
NOTIFICATION_REQUIRED = ["CO_MUN_RES", "CS_SEXO", "NU_IDADE_N", "DT_SIN_PRI", "CLASSI_FIN", "EVOLUCAO"]
NOTIFICATION_OPTIONAL = ["CO_MUN_NOT", "CS_RACA", "CS_GESTANT", "DT_EVOLUCA", "DT_NOTIFIC", "TP_IDADE"]
EXTRACTION_LOG_FIELDS = [
    "extraction_id", "source_id", "operation", "requested_period", "territory", "started_at", "finished_at",
    "status", "records", "sha256", "raw_path", "validation_summary", "error_or_note",
]

# --- Fixed values: admission table labels ---------------------------------------------
# (accent-free lower-case label, "prefix" or "equal", component id), first match wins.
TABLE_TOTAL = "Total"
REGISTRY_FIELD = "Casos"
PAGE_MARKS = ["TabNet Win32", '"Total"', "Sistema de Informações Hospitalares"]
ADMISSION_LABEL_EXCLUDED = ["isquem transit", "sindr cor"]
ADMISSION_LABELS = [
    ("10 doencas do aparelho respiratorio", "prefix", "resp_all"),
    ("pneumonia", "equal", "pneumonia"),
    ("bronquite aguda e bronquiolite aguda", "prefix", "acute_bronchitis_bronchiolitis"),
    ("bronquite enfisema e outr doen", "prefix", "copd"),
    ("asma", "equal", "asthma"),
    ("pneumoconiose", "prefix", "pneumoconiosis"),
    ("09 doencas do aparelho circulatorio", "prefix", "cardio_all"),
    ("hipertensao essencial", "prefix", "hypertension_essential"),
    ("outras doencas hipertensivas", "prefix", "hypertension_other"),
    ("infarto agudo do miocardio", "prefix", "acute_myocardial_infarction"),
    ("outras doencas isquemicas do coracao", "prefix", "ischemic_heart_disease_other"),
    ("embolia pulmonar", "prefix", "pulmonary_embolism"),
    ("transtornos de conducao e arritmias cardiacas", "prefix", "cardiac_arrhythmia"),
    ("insuficiencia cardiaca", "prefix", "heart_failure"),
    ("hemorragia intracraniana", "prefix", "cerebrovascular_hemorrhage"),
    ("infarto cerebral", "prefix", "cerebrovascular_infarction"),
    ("acid vascular cerebr", "prefix", "cerebrovascular_unspecified"),
    ("outras doencas cerebrovasculares", "prefix", "cerebrovascular_other"),
]
# component id -> outcome ids it adds to; the integrated outcome takes both chapter totals.
ADMISSION_COMPONENTS = [
    ("resp_all", "resp_all"),
    ("resp_all", "cardiorespiratory_all"),
    ("pneumonia", "pneumonia"),
    ("acute_bronchitis_bronchiolitis", "acute_bronchitis_bronchiolitis"),
    ("copd", "copd"),
    ("asthma", "asthma"),
    ("pneumoconiosis", "pneumoconiosis"),
    ("cardio_all", "cardio_all"),
    ("cardio_all", "cardiorespiratory_all"),
    ("hypertension_essential", "hypertension"),
    ("hypertension_other", "hypertension"),
    ("acute_myocardial_infarction", "ischemic_heart_disease"),
    ("ischemic_heart_disease_other", "ischemic_heart_disease"),
    ("acute_myocardial_infarction", "acute_myocardial_infarction"),
    ("pulmonary_embolism", "pulmonary_embolism"),
    ("cardiac_arrhythmia", "cardiac_arrhythmia"),
    ("heart_failure", "heart_failure"),
    ("cerebrovascular_hemorrhage", "cerebrovascular"),
    ("cerebrovascular_infarction", "cerebrovascular"),
    ("cerebrovascular_unspecified", "cerebrovascular"),
    ("cerebrovascular_other", "cerebrovascular"),
]
ADMISSION_OUTCOME_LABELS = {
    "resp_all": "10 Doenças do aparelho respiratório",
    "pneumonia": "Pneumonia",
    "acute_bronchitis_bronchiolitis": "Bronquite aguda e bronquiolite aguda",
    "copd": "Bronquite enfisema e outr doenç pulm obstr crôn",
    "asthma": "Asma",
    "pneumoconiosis": "Pneumoconiose",
    "cardio_all": "Todas as doenças do aparelho circulatório",
    "hypertension": "Doenças hipertensivas",
    "ischemic_heart_disease": "Doenças isquêmicas do coração",
    "acute_myocardial_infarction": "Infarto agudo do miocárdio",
    "pulmonary_embolism": "Embolia pulmonar",
    "cardiac_arrhythmia": "Transtornos de condução e arritmias cardíacas",
    "heart_failure": "Insuficiência cardíaca",
    "cerebrovascular": "Doenças cerebrovasculares",
    "cardiorespiratory_all": "Todas as doenças cardiorrespiratórias",
}
INTEGRATED_OUTCOME = "cardiorespiratory_all"
INTEGRATED_PARTS = ["resp_all", "cardio_all"]
# Labels of the national monthly table and the outcomes each one counts towards.
DEMENTIA_LABELS = [
    ("doença de alzheimer", "alzheimer"),
    ("doença de alzheimer", "dementias_all"),
    ("demência", "dementias_all"),
]

# --- Fixed values: registry site groups -----------------------------------------------
SITE_GROUPS = [
    ("mama", ["C50"]),
    ("colorretal", ["C18", "C19", "C20", "C21"]),
    ("colo do útero", ["C53"]),
    ("próstata", ["C61"]),
    ("hematológicos selecionados", ["C81", "C83", "C88", "C90", "C91", "C92", "C94", "C96"]),
    ("pulmão", ["C34"]),
    ("estômago", ["C16"]),
]

# --- Fixed values: public documents ---------------------------------------------------
SMALL_CELL = 5
RATE_MULTIPLIER = 100_000.0
Z_975 = 1.959963984540054
SOURCE_ATTRIBUTES = [
    ("SIH", "hospitalization", "Internações hospitalares (AIHs)", "internações/AIHs de residentes"),
    ("SIM", "mortality", "Mortalidade", "óbitos de residentes pela causa básica"),
]
# What the catalogue says about each source: (source, short name, definition, what its figures do not show).
SOURCE_TEXTS = [
    ("SIH", "SIH/SUS — DATASUS",
     "Eventos de internação registrados em Autorizações de Internação Hospitalar por município de residência. "
     "Não representam pessoas únicas nem casos novos.",
     "Não representa pessoas únicas, casos novos, incidência ou prevalência da doença."),
    ("SIM", "SIM — Ministério da Saúde",
     "Óbitos de residentes classificados pela causa básica no Sistema de Informação sobre Mortalidade. "
     "Esses óbitos não representam incidência, prevalência ou todos os casos existentes da doença.",
     "Não mede causalidade ambiental, risco individual, incidência ou prevalência da doença."),
]
ALLOWED_CONCLUSION = (
    "Descreve a frequência e a taxa registrada entre residentes e permite comparações descritivas com os territórios disponíveis."
)
STANDARD_POPULATION_LABEL = "Brasil — Censo 2022"
MAP_PENDING = "context_only_pending_validated_municipal_rates"
MAP_NOTES = {
    "SIM": "Taxa bruta municipal de mortalidade SIM {} por residência; células <5 suprimidas.",
    "SIH": "Taxa bruta municipal de internações SIH {} por residência; AIHs são eventos e células <5 estão suprimidas.",
    "standardized": "Taxa padronizada por idade e sexo pela população do Brasil no Censo 2022; células com contagem total <5 estão suprimidas.",
}
SUPPRESSION_REASON = "small_cell_lt_5"
# Texts beside a compared figure: none, equal, above, below; and change: steady, above, below.
RELATIVE_TEXTS = ("Comparação indisponível", "Taxa semelhante", "acima", "abaixo")
DIRECTION_TEXTS = ("estável em relação a", "acima de", "abaixo de")
# Findings of the release audit with their severity.
RELEASE_FINDINGS = {
    "release-not-public": "blocker",
    "review-gates-pending": "blocker",
    "municipal-map-not-publishable": "blocker",
    "sih-brazil-comparator-missing": "blocker",
    "profiles-incomplete": "blocker",
    "denominator-gaps": "warning",
    "contract-incomplete": "blocker",
    "small-cell-leak": "blocker",
    "download-suppression-leak": "blocker",
    "profile-suppression-leak": "blocker",
    "profile-municipality-coverage": "blocker",
    "source-catalog-open-items": "warning",
    "provisional-observations": "warning",
}
RELEASE_COMPARATORS = ("rest_of_rj_excluding_selected_municipality", "brazil_total")
SYNONYMS = {
    "lung": ["pulmão", "câncer de pulmão", "bronquios", "traqueia"],
    "pneumonia": ["pneumonia", "infecção pulmonar"],
    "acute_myocardial_infarction": ["infarto", "ataque cardíaco", "iam"],
    "all_malignant_neoplasms": ["câncer", "cancer", "neoplasias"],
    "alzheimer": ["alzheimer", "demência de alzheimer", "perda de memória"],
    "dementias_all": ["demência", "demências", "alzheimer", "perda de memória"],
}
# (source, outcomes with a manifest of their own, that manifest, the manifest of all others).
MANIFEST_REFS = [
    ("SIH", ["alzheimer", "dementias_all"], "reports/quality/sih_neurological_rates_manifest.json", "reports/quality/respiratory_rates_manifest.json"),
    ("SIM", ["alzheimer", "dementias_all"], "reports/quality/sim_neurological_rates_manifest.json", "reports/quality/sim_mortality_rates_manifest.json"),
]
STANDARDIZED_MANIFEST = "reports/quality/sim_neurological_standardized_manifest.json"
GEOGRAPHY_BASIS = "residence"
# States of snapshots and texts of public records.
RECONCILED, NOT_RECONCILED = "reconciled_with_annual_series", "reconciliation_failed"
VALIDATED_DEATHS = "validated_sim_"
MAP_STATUS = ("validated_", "_municipal_residence_rates_")
MAP_SCHEMA, STANDARDIZED_MAP_SCHEMA = "1.0.0", "1.1.0"
STANDARDIZED_METRIC, CRUDE_METRIC = "age_sex_standardized_rate_per_100k", "crude_rate_per_100k"
STANDARDIZED_KIND, CRUDE_KIND = "age_sex_standardized", "crude"
STANDARDIZATION, NO_STANDARDIZATION = ("age_sex_standardized_", "_and_crude_annual"), "crude_only"
AVAILABLE, NOT_AVAILABLE, NO_PROFILE = "available_", "not_available", "not_applicable_current_release"
AVAILABLE_PROFILE = "available_2022_sim_age_sex"
ADMISSION_UNIT = "internações agregadas pelo SIH"
OBSERVATION_FIELDS = [
    "source", "outcomeId", "geographyId", "period", "metricKind", "value", "count", "denominator",
    "ciLow", "ciHigh", "dataStatus", "periodStatus", "suppressed", "manifestRef",
]
PROFILE_FIELDS = [
    "municipalityCode", "indicatorId", "period", "ageGroup", "sex", "count", "denominator", "ratePer100k",
    "ciLow", "ciHigh", "suppressionStatus", "dataStatus", "manifestRef",
]
PROTECTED_FIELDS = ["value", "count", "ciLow", "ciHigh"]
PROTECTED_PROFILE_FIELDS = ["count", "ratePer100k", "ciLow", "ciHigh"]
DOWNLOAD_FIELDS = [
    "indicatorId", "source", "outcomeId", "geographyId", "period", "metricKind", "value", "count", "denominator",
    "ciLow", "ciHigh", "dataStatus", "periodStatus", "suppressed", "manifestRef",
]


@dataclass(frozen=True)
class Territory:
    """The selected city inside its state; every operator takes this as a parameter."""

    state_prefix: str = "33"
    selected_code6: str = "330630"
    selected_code7: str = "3306305"


@dataclass(frozen=True)
class ComparatorSet:
    """Areas to compare with, named by codes or prefixes of codes (the empty prefix names all).

    The area that is compared is left out unless ``own_included``.
    """

    id: str
    prefixes: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    own_included: bool = False


#: Municipalities of the region around the configured city, by six-digit code.
REGION_CODES = (
    "330030", "330040", "330225", "330395", "330400", "330411", "330412", "330420", "330440", "330450", "330610", "330630",
)


def comparator_sets(territory: Territory, region: tuple[str, ...] = REGION_CODES, listed: tuple[str, ...] = ()) -> list[ComparatorSet]:
    """The configured comparators: rest of the state, the country, the region, and a list fixed beforehand (if any)."""
    sets = [
        ComparatorSet("rest_of_rj_excluding_selected_municipality", prefixes=(territory.state_prefix,)),
        ComparatorSet("brazil_total", prefixes=("",), own_included=True),
        ComparatorSet("medio_paraiba_without_vr", codes=region),
    ]
    return [*sets, ComparatorSet("pre_specified_comparable_municipalities", codes=listed)] if listed else sets


@dataclass(frozen=True)
class Outcome:
    section: str
    id: str
    label: str
    ranges: tuple[str, ...]
    sources: tuple[str, ...]


def outcome_definitions(source: str | None = None, exclude: tuple[str, ...] = ()) -> list[Outcome]:
    """Configured outcomes; with ``source``, only those it can classify by diagnosis code."""
    chosen = [Outcome(s, i, l, tuple(r), tuple(src)) for s, i, l, r, src in OUTCOMES]
    if source is not None:
        chosen = [o for o in chosen if source in o.sources and o.ranges]
    return [o for o in chosen if o.id not in exclude]
