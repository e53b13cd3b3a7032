"""Code systems, profiles and codes of the oncology data model."""

_MII = "https://www.medizininformatik-initiative.de/fhir"
_ONKO_CS = f"{_MII}/ext/modul-onko/CodeSystem"
_ONKO_SD = f"{_MII}/ext/modul-onko/StructureDefinition"

# General code systems
ICD10 = "http://fhir.de/CodeSystem/bfarm/icd-10-gm"
ICDO3_TOPOGRAPHY = "http://terminology.hl7.org/CodeSystem/icd-o-3"
LOINC = "http://loinc.org"
SNOMED = "http://snomed.info/sct"
UICC_TNM = "https://www.uicc.org/resources/tnm"
OPS = "http://fhir.de/CodeSystem/bfarm/ops"
ATC_NATIONAL = "http://fhir.de/CodeSystem/bfarm/atc"
ATC_WHO = "http://www.whocc.no/atc"
OBSERVATION_CATEGORY = "http://terminology.hl7.org/CodeSystem/observation-category"
VERIFICATION_STATUS = "http://terminology.hl7.org/CodeSystem/condition-ver-status"

# Oncology code systems
ASSESSMENT = f"{_ONKO_CS}/mii-cs-onko-verlauf-gesamtbeurteilung"
GRADING = f"{_ONKO_CS}/mii-cs-onko-grading"
ECOG = f"{_ONKO_CS}/mii-cs-onko-allgemeiner-leistungszustand-ecog"
KARNOFSKY = f"{_ONKO_CS}/mii-cs-onko-allgemeiner-leistungszustand-karnofsky"
DEATH_BY_TUMOUR = f"{_ONKO_CS}/mii-cs-onko-tod"
METASTASIS_SITE = f"{_ONKO_CS}/mii-cs-onko-fernmetastasen"
INTENTION = f"{_ONKO_CS}/mii-cs-onko-intention"
RELATION_TO_SURGERY = f"{_ONKO_CS}/mii-cs-onko-therapie-stellungzurop"
THERAPY_TYPE = f"{_ONKO_CS}/mii-cs-onko-therapie-typ"
THERAPY_END_REASON = f"{_ONKO_CS}/mii-cs-onko-therapie-ende-grund"
TARGET_REGION = f"{_ONKO_CS}/mii-cs-onko-strahlentherapie-zielgebiet"
RESIDUAL_STATUS = f"{_ONKO_CS}/mii-cs-onko-residualstatus"

# Extensions
ASSERTED_DATE = "http://hl7.org/fhir/StructureDefinition/condition-assertedDate"
MORPHOLOGY = f"{_ONKO_SD}/mii-ex-onko-histology-morphology-behavior-icdo3"
TNM_PREFIX = f"{_ONKO_SD}/mii-ex-onko-tnm-cp-praefix"
SYSTEM_INTENTION = f"{_ONKO_SD}/mii-ex-onko-systemische-therapie-intention"
SYSTEM_RELATION = f"{_ONKO_SD}/mii-ex-onko-systemische-therapie-stellungzurop"
RADIO_INTENTION = f"{_ONKO_SD}/mii-ex-onko-strahlentherapie-intention"
RADIO_RELATION = f"{_ONKO_SD}/mii-ex-onko-strahlentherapie-stellungzurop"
SURGERY_INTENTION = f"{_ONKO_SD}/mii-ex-onko-operation-intention"

# Profiles
PRIMARY_TUMOUR = f"{_ONKO_SD}/mii-pr-onko-diagnose-primaertumor"
OTHER_CLASSIFICATION = f"{_ONKO_SD}/mii-pr-onko-weitere-klassifikationen"
RADIOTHERAPY = f"{_ONKO_SD}/mii-pr-onko-strahlentherapie"
IRRADIATION = f"{_ONKO_SD}/mii-pr-onko-strahlentherapie-bestrahlung-strahlentherapie"
SURGERY = f"{_ONKO_SD}/mii-pr-onko-operation"
SYSTEM_THERAPY = f"{_ONKO_SD}/mii-pr-onko-systemische-therapie"

# SNOMED CT
DEATH_CODE = "184305005"
GLEASON_CODE = "1812491000004107"
METASTASIS_CODE = "385421009"
PROGRESSION_CODE = "396432002"
PRIMARY_STATUS_CODE = "445200009"
LYMPH_NODE_STATUS_CODE = "399656008"
DISTANT_STATUS_CODE = "399608002"
ECOG_CODE = "423740007"
KARNOFSKY_CODE = "761869008"
# Code -> prefixed category, per TNM dimension
TNM_CODES = {
    "t": {"78873005": "T", "399504009": "cT", "384625004": "pT"},
    "n": {"277206009": "N", "399534004": "cN", "371494008": "pN"},
    "m": {"277208005": "M", "399387003": "cM", "371497001": "pM"},
    "uicc": {"399390009": "UICC", "399537006": "cUICC", "399588009": "pUICC"},
}

# LOINC
GRADING_LOINC = "33732-9"
VITAL_STATUS_LOINC = "67162-8"
Y_SYMBOL_LOINC = "101658-3"
GENETIC_VARIANT_LOINC = "69548-6"

# Prostate cancer cohort of the treatment question
PROSTATE = "C61"
ENZALUTAMIDE = "L02BB04"
EARLY_STAGES = ("N0", "M0")

# Systems of the hospital exports
PZN = "http://fhir.de/CodeSystem/ifa/pzn"
ACT_CODE = "http://terminology.hl7.org/CodeSystem/v3-ActCode"
VARIANT_TRAIT = f"{_ONKO_CS}/mii-cs-onko-genetische-variante-auspraegung"
