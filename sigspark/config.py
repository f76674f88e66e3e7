"""Default thresholds and labels.

Fixed values: these must equal the reference pipeline's settings for the
results to agree, so they are stated here once and used as keyword
defaults everywhere.
"""

# --- fixed values (thresholds) ---
Z_THRESHOLD = 2.0            # significant |Z|
HIGH_CONFIDENCE_Z = 3.0      # potency / high-confidence |Z|
EXTREME_Z = 4.0              # extreme |Z|
TOP_N_LEADS = 10
MAX_AFFECTED_GENES = 50
MIN_POTENCY = 8.0
MASTER_REGULATOR_FREQ = 15
MIN_NON_NULL_SHARE = 0.90
MAX_DUPLICATE_SHARE = 0.05
MAX_NULL_SHARE = 0.10
TIME_POINTS = ("6 h", "24 h")
CASCADE_DELTA = 15
RAPID_GENES_6H = 25
RISK_MAX_EXTREME_GENES = 30
NOVELTY_THRESHOLD = 5
RISK_LOW_ABOVE = 50
RISK_MEDIUM_ABOVE = 10
MATURITY_ESTABLISHED_ABOVE = 100
OUTLIER_THRESHOLD = 1.5

# --- fixed values (target signature selection) ---
TARGET_CELL = "MCF7"
TARGET_DOSE = 10.0
TARGET_DOSE_UNITS = ("µm", "µM")   # micro sign U+00B5, both cases
TREATMENT_TYPE = "trt_cp"
UNKNOWN_PREFIX = "BRD-"

# --- fixed values (default question parameters) ---
SINGLE_TARGET_GENE = "DDIT4"
REVERSAL_GENES = ("DDIT4", "PSME1")
REFERENCE_COMPOUND = "bortezomib"
CLASS_MARKER_GENES = ("DDIT4", "HSPA5")
CLASS_MEMBERS = ("bortezomib", "ixazomib", "MG-132")

# --- fixed values (labels) ---
PROFILE_PRECISION = "Precision_Lead"
PROFILE_BROAD = "Broad_Spectrum"
PROFILE_MODERATE = "Moderate_Impact"
PROFILE_LOW = "Low_Activity"
PROFILE_UNKNOWN = "Unknown"

TRIAGE_CASCADE = "Cascade Inducer (Chronic/Systemic)"
TRIAGE_RAPID = "Rapid Responder (Acute/Targeted)"
TRIAGE_GRADUAL = "Gradual Modulator (Steady State)"
TRIAGE_SUSTAINED = "Sustained Shock (Stable Profile)"

CATEGORY_NOVEL = "Novel Mechanism"
CATEGORY_SUPPRESSOR = "Targeted Suppressor"
CATEGORY_ACTIVATOR = "Pathway Activator"
CATEGORY_COMPLEX = "Complex Regulator"

DRUG_TYPE_UNKNOWN = "Unknown (BRD Compound)"
DRUG_TYPE_KNOWN = "Known/Approved Drug"

NOVELTY_NOVEL = "novel"
NOVELTY_ESTABLISHED = "established"
NOVELTY_ERROR = "error"
RISK_LOW = "LOW"
RISK_MEDIUM = "MEDIUM"
RISK_HIGH = "HIGH"

MATURITY_ESTABLISHED = "Highly Established"
MATURITY_EMERGING = "Emerging"
MATURITY_NOVEL = "Novel IP (Unpatented)"
MATURITY_ERROR = "Error"

# --- fixed values (gene function lookup, symbol -> function) ---
GENE_FUNCTIONS = {
    "ATP6V1D": "Proton Transport",
    "CDK6": "Cell Cycle/Growth",
    "HMGCS1": "Cholesterol Metabolism",
    "JMJD6": "Epigenetics",
    "KLHL21": "Protein Degradation",
    "MCOLN1": "Lysosomal Function",
    "PGAM1": "Glycolysis / Energy",
    "RPA3": "DNA Replication / Repair",
    "TXNDC9": "Cell Survival / Folding",
    "CSRP1": "Cellular Structure",
}
GENE_FUNCTION_DEFAULT = "Targeted Regulation"

# --- fixed values (tokens that pandas reads as missing; null after a string read) ---
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                  "NULL", "NaN", "None", "n/a", "nan", "null")
