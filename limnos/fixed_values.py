"""Names, labels, patterns and constants that decide results.

They are data, not logic: each one must be exactly as written for results to agree with
the published analysis of the national survey and laboratory records.
"""

# --- laboratory parameters kept by name -------------------------------------------------
PARAMETER_NAMES = [
    "Vattentemperatur", "Syrgashalt", "Totalfosfor", "Nitrit+Nitratkväve", "Fosfatfosfor",
    "Ammoniumkväve", "Konduktivitet 25°", "pH", "Syrgasmättnad", "Absorbans filtrerat (420 nm)",
    "Tot. org. kol TOC", "Turbiditet FNU", "Tot-N(TNb)", "Klorofyll a", "Alkalinitet/Acid.",
    "Tot-N(persulfat)", "Absorbans filtrerat (436 nm)", "Absorbans filtrerat (254 nm)",
    "Absorbans filtrerat (365 nm)", "Alkalinitet", "Absorbans ofiltrerat (420 nm)", "Siktdjup",
    "Siktdjup utan vattenkikare", "Salinitet", "Siktdjup med vattenkikare", "Tot-N",
    "Löst organiskt kol", "Färgtal", "Turbiditet NTU", "Kjeldahlkväve", "Nitratkväve",
    "Nitritkväve", "Kond", "Totalfosfor (ICP)", "Konduktivitet 20°", "Filtrerad totalfosfor",
    "Tot-N(summa)", "Totalfosfor filtrerad (ICP)", "Turb",
]

# --- detection limits -------------------------------------------------------------------
BELOW_LIMIT_FACTOR = 0.5
ABOVE_LIMIT_FACTOR = 1.1
NUMBER_IN_TEXT = r"\(?[0-9,.]+\)?"
INDEX_NUMBER = r"\d+\.*\d*"

# --- alkalinity / acidity ---------------------------------------------------------------
ALK_ACID = "Alk/Acid"
ALK_CODE = "Alk"
ALK_ABBREV = "Alk."
ALK_NAME = "Alkalinitet"

# --- unit dictionary columns, in file order ---------------------------------------------
UNIT_DICTIONARY_COLUMNS = [
    "id", "propertyAbbrevName", "unitC", "unitAlt", "convFactRaw", "unitC_alt", "unitAlt_alt", "sigfig",
]

# --- keys of the depth mean -------------------------------------------------------------
DEPTH_MEAN_KEYS = [
    "samplingSiteId", "samplingDate", "samplingSiteName", "samplingSiteX", "samplingSiteY",
    "minDepth", "maxDepth", "stationId", "stationName", "county", "municipality",
    "propertyCode", "propertyAbbrevName", "propertyName", "unitF",
]

# --- site-year chemistry ----------------------------------------------------------------
DROPPED_CODES = ["NH4_N", "NO2_NO3_N", "PO4_P", "Kjeldahl_N", "NO2_N", "NO3_N"]
SPARSE_CODES = [
    "Abs_OF420", "Siktdjup", "Turb_FNU", "O2", "SaO2", "DOC", "Abs_F254", "Abs_F365", "Abs_436m",
    "Siktdjup_utan_kikare", "Siktdjup_kikare", "Farg", "P_ICP", "Kond", "Salinitet", "Tot_P_F",
]
TOTAL_NITROGEN_PRIORITY = ["Tot_N_TNb", "Tot_N_ps", "Tot_N_summa", "Tot_N"]
SUMMER_MONTHS = [6, 7, 8]
SHOULDER_MONTHS = [5, 9]
SEASON_CHECK_MONTHS = [6, 7, 8, 9]
SUMMER_WEIGHT = 3
SHOULDER_WEIGHT = 2

# --- sample metadata labels -> column names ---------------------------------------------
SAMPLE_METADATA_NAMES = {
    "Vattennivå": "waterLevel",
    "Provtagningsmetodens standard (metodstandard för biologisk provtagning)": "stdSamplingMethod",
    "Sjösänkning": "lakeDrainage",
    "Hydromorfologisk påverkan": "hydromorphImpact",
    "Helsjö/Del av sjö": "lakeWholeOrPart",
    "Inventerade transekter": "inventoryTransect",
    "Inventerade krattdrag/rutor": "inventoryQuadrat",
    "Siktdjup (m)": "secchi",
}

# --- observation metadata labels -> column names ----------------------------------------
OBSERVATION_METADATA_NAMES = {
    "Vattendjup (m)": "waterDepth",
    "Provtagningsmetod (biologisk provtagning)": "samplingMethod",
    "Provplatskoordinat START N/X": "siteCoordStartX",
    "Provplatskoordinat START E/Y": "siteCoordStartY",
    "Provplatskoordinat SLUT N/X": "siteCoordEndX",
    "Provplatskoordinat SLUT E/Y": "siteCoordEndY",
    "Provplatskoordinaternas koordinatsystem": "siteCoordCRS",
    "Avstånd från strandlinjen (m)": "shorelineDist",
    "Bottensubstrat, organiskt, dominerande typ. D1": "dominantOrgSubstrate",
    "Avvikelse från normal vattennivå (m)": "waterLevelDeviation",
    "Dominerande sedimentkaraktär angivet i huvudfraktioner": "dominantSubstrateFract",
    "Dominerande substrattyp": "dominantSubstrate",
    "Bottensubstrat, dominerande oorganiskt. D1: SS EN ISO 14688-1": "dominantInorgSubstrateV1",
    "Dominerande oorganiskt bottensubstrat enligt Undersökningstyp v3": "dominantInorgSubstrateV3",
}

# --- survey indices ---------------------------------------------------------------------
INDEX_RICHNESS = "Mfr arter"
INDEX_LISTED_RICHNESS = "TMI arter"
INDEX_TROPHIC = "TMI"
INDEX_INPUTS = "compTMI"
INDEX_PRODUCT_SUM = r"Summa produkt=\s*(.*?)\s*;Summa viktfaktor"
INDEX_WEIGHT_PREFIX = r".*?Summa viktfaktor="

# --- sampling method text -> indicator --------------------------------------------------
METHOD_FLAGS = {
    "sampleRake": ["kratta", "räfsa", "krattning"],
    "sampleSnorkel": ["snorkling"],
    "sampleDive": ["dykning"],
    "sampleBino": ["vattenkikare"],
    "sampleGrid": ["inventeringsruta"],
    "sampleHand": ["utan hjälpmedel"],
}

# --- grain-size text -> rank (smallest to largest) --------------------------------------
SUBSTRATE_RANKS_V1 = {
    "ler ≤ 0,002 mm": 1, "silt 0,002-0,063 mm": 1,
    "sand 0,063-2,0 mm": 2, "fingrus 2,0-6,3 mm": 2,
    "mellangrus 6,3-20 mm": 3, "grovgrus 20-63 mm": 3, "grus 2,0-63 mm": 3,
    "sten 63-200 mm": 4,
    "block 200-630 mm": 5,
    "stora block 630-2000 mm": 6, "stora block >630 mm": 6, "mycket stora block >2000 mm": 6,
}
SUBSTRATE_RANKS_V3 = {
    "ler-silt ≤0,063 mm": 1, "sand-fingrus >0,063-6,3 mm": 2, "mellan-grovgrus >6,3-63 mm": 3,
    "sten >63-200 mm": 4, "block >200-630 mm": 5, "stora block >630 mm": 6,
}

# --- taxon names ------------------------------------------------------------------------
PLACEHOLDER_TAXON = "Biota"
EXCLUDED_TAXA = [
    "Algae", "Biota", "Cladophoraceae", "Cladophora", "Cladophora glomerata", "Cyanobacteria",
    "Dichothrix orsiniana", "Dreissena polymorpha", "Batrachospermum", "Batrachospermum gelatinosum",
    "Chaetophora lobata", "Chlorophyceae", "Chlorophyta", "Ephydatia fluviatilis", "Hapalosiphon",
    "Hildenbrandia", "Hildenbrandia rubra", "Inget fynd", "Mesogloia vermiculata", "Microcystis",
    "Mougeotia", "Nostoc", "Nostoc pruniforme", "Nostoc zetterstedtii", "Oedogonium",
    "Paludicola keratophyta", "Paludicola turfosa", "Porifera", "Rhizoclonium hieroglyphicum",
    "Rhodophyta", "Spongilla", "Spongilla lacustris", "Spongillidae", "Stigonema informe",
    "Stigonema ocellatum var. globosum", "Tolypothrix", "Tolypothrix saviczii", "Trådalg", "Ulothrix",
    "Ulva", "Ulva intestinalis", "Ulva pilifera", "Vaucheria", "Vaucheria dichotoma",
    "Aegagropila linnaei",
]
HYBRID_MARKS = ["×", " x ", "/"]
AGGREGATE_PATTERNS = [("s.lat.", ""), ("s. lat.", ""), ("agg.", "")]
INFRASPECIFIC_MARKS = [r"var\.", r"subsp\."]
TAXON_PATTERNS = [
    ("Möja$", "Ranunculus"),
    ("Knoppslinga$", "Myriophyllum sibiricum"),
    ("Trådstarr$", "Carex lasiocarpa"),
    ("Cardamine$", "Cardamine pratensis"),
    ("Iris$", "Iris pseudacorus"),
    ("Riccia$", "Riccia fluitans"),
    ("Scutellaria$", "Scutellaria galericulata"),
    ("Philonotis$", "Philonotis fontana"),
    ("Pohlia$", "Pohlia wahlenbergii"),
    ("Barbilophozia lycopodioides", "Barbilophozia"),
    ("Deschampsia cespitosa", "Deschampsia"),
    ("Jungermannia eucordifolia", "Jungermannia"),
    ("Oncophorus integerrimus", "Oncophorus"),
    ("Spirogyra groenlandica", "Spirogyra"),
    ("Sphagnum subgen. Acutifolia sect. Acutifolia", "Sphagnum"),
    ("Sphagnum subg. Cuspidata", "Sphagnum"),
    ("Sphagnum subg. Sphagnum", "Sphagnum"),
    ("Sphagnum subg. Subsecunda", "Sphagnum"),
    ("Ranunculus batrachium", "Ranunculus"),
]

# --- survey selection -------------------------------------------------------------------
MISSING_TEXT = "saknas"
MISLOCATED_SITES = [6679]

# --- reporting --------------------------------------------------------------------------
CORRELATION_COLUMNS = {
    "samplingYr": "Year", "samplingM": "Month", "samplingSiteX": "X", "samplingSiteY": "Y",
    "rich": "Richness", "tmiRich": "TMI Richness", "tmi": "TMI", "murphyRich": "Murphy Richness",
    "maxRich": "Full Richness", "observationCount": "Count",
}
CORRELATION_COLUMNS_FULL = {
    "samplingM": "Month", "samplingYr": "Year", "samplingSiteX": "X", "samplingSiteY": "Y",
    "rich": "WFD Richness", "murphyRich": "Murphy Richness", "maxRich": "Full Richness",
    "tmiRich": "TMI Richness", "tmi": "TMI", "observationCount": "# Obs", "Alk": "Alkalinity",
    "Kfyll": "Chlorophyl-a", "Kond_25": "Conductivity", "TOC": "TOC", "pH": "pH", "Tot_P": "TP",
    "Temp": "T", "TN": "TN",
}
SCALE_RANGES = {"large": (100000.0, None), "medium": (10000.0, 100000.0), "small": (0.0, 10000.0)}
SCALE_ORDER = ["small", "medium", "large"]
MODEL_COVARIATES = {"TN": "TNsq", "Temp": "Tsq", "Tot_P": "TPsq"}
EFFECT_LEVELS = {"TPsq": "TP^2", "TP": "TP", "Tsq": "T^2", "T": "T", "TNsq": "TN^2", "TN": "TN"}
SHORT_NAMES = [("Tot_P", "TP"), ("Temp", "T")]
MODEL_LABEL_PATTERNS = [("sq", "(^2"), (r";\p{Alpha}{1,2}\(", ""), (";", " + ")]

# Columns that surveys no longer need at the end.
SURVEY_COLUMNS_DROPPED_AT_END = [
    "sampleId", "flagCodes", "relativeLocationType", "stationId", "stationName", "stationType", "stationEUID",
    "stationCoordinateX", "stationCoordinateY", "waterLevel", "lakeDrainage", "hydromorphImpact",
    "inventoryTransect", "inventoryQuadrat", "insertDate", "editDate", "lastEdit", "productSum",
    "weightFactorSum", "analysisDate", "inorgSubstrateMin", "inorgSubstrateMax", "inorgSubstrateMed",
    "siteIdUnique",
]
