"""Fixed values that must equal the reference's for right results.

Code lists, labels and thresholds are stated here plainly, in natural order.
"""

# ---- fixed values: action_taken code → outcome label (HMDA codes 1..8) ----
ACTION_LABELS = {
    1: "Loan originated",
    2: "Application approved but not accepted",
    3: "Application denied",
    4: "Application withdrawn by applicant",
    5: "File closed for incompleteness",
    6: "Purchased loan",
    7: "Preapproval request denied",
    8: "Preapproval request approved but not accepted",
}

# ---- fixed values: denial reason code → label ----
DENIAL_REASON_LABELS = {
    1: "Debt-to-income ratio",
    2: "Employment history",
    3: "Credit history",
    4: "Collateral",
    5: "Insufficient cash",
    6: "Unverifiable information",
    7: "Credit application incomplete",
    8: "Mortgage insurance denied",
    9: "Other",
    10: "Not applicable",
}

DENIAL_REASON_COLUMNS = ["denial_reason-1", "denial_reason-2", "denial_reason-3", "denial_reason-4"]

# ---- fixed values: analysed race groups and their short names ----
RACES = [
    "White",
    "Black or African American",
    "Asian",
    "American Indian or Alaska Native",
]
RACE_SHORT = {
    "White": "White",
    "Black or African American": "Black",
    "Asian": "Asian",
    "American Indian or Alaska Native": "Native",
}

# ---- fixed values: placeholders removed by the cleaning steps ----
RACE_PLACEHOLDERS = ["Race Not Available", "Free Form Text Only"]
ETHNICITY_PLACEHOLDERS = ["Ethnicity Not Available", "Free Form Text Only"]
SEX_PLACEHOLDER = "Sex Not Available"
AGE_PLACEHOLDER = 8888
DTI_DROP_TOKENS = ["NA", "Exempt"]
COMMERCIAL_CODES = [1, 1111]
CONFORMING_PLACEHOLDER = "NA"

# ---- fixed values: ordered DTI labels for ordinal encoding ----
DTI_ORDER = [
    "<20%", "20%-<30%", "30%-<36%", "36%-<40%",
    "40%-<45%", "45%-<50%", "50%-60%", ">60%", "Exempt",
]

# ---- fixed values: interval bins for the controlled rate comparison ----
DTI_EDGES = [0, 20, 30, 40, 50, 65]
DTI_BIN_LABELS = ["<20%", "20-30%", "30-40%", "40-50%", "50-65%"]
INCOME_EDGES = [0, 50000, 75000, 100000, 150000, 500000]
INCOME_BIN_LABELS = ["<$50k", "$50-75k", "$75-100k", "$100-150k", "$150k+"]
MID_DTI_BINS = ["20-30%", "30-40%", "40-50%"]
MID_INCOME_BINS = ["$50-75k", "$75-100k", "$100-150k", "$150k+"]

# ---- fixed values: tokens a CSV reader treats as missing (exact match) ----
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# ---- fixed values: registry name placeholders (after strip) ----
NAME_PLACEHOLDERS = ["", "nan", "None", "NONE"]
UNKNOWN_NAME = "Unknown LEI Name"
BAD_KEYS = ["", "NAN"]

# ---- fixed values: columns that must be present in a cleaned row ----
PRICING_REQUIRED = [
    "lei", "action_taken", "interest_rate", "loan_amount", "rate_spread",
    "total_loan_costs", "discount_points", "income", "property_value",
    "lender_credits", "loan_term", "loan_purpose", "loan_type", "occupancy_type",
    "derived_loan_product_type", "derived_dwelling_category", "county_code",
    "derived_msa-md", "activity_year", "tract_to_msa_income_percentage",
    "tract_population", "tract_minority_population_percentage",
    "ffiec_msa_md_median_family_income", "tract_owner_occupied_units",
    "tract_one_to_four_family_homes", "tract_median_age_of_housing_units",
]
DENIAL_REQUIRED = [
    "lei", "action_taken", "loan_amount", "income", "property_value", "loan_term",
    "loan_purpose", "loan_type", "occupancy_type", "derived_loan_product_type",
    "derived_dwelling_category", "county_code", "derived_msa-md", "activity_year",
    "tract_to_msa_income_percentage", "tract_population",
    "tract_minority_population_percentage", "ffiec_msa_md_median_family_income",
    "tract_owner_occupied_units", "tract_one_to_four_family_homes",
    "tract_median_age_of_housing_units", "denial_reason-1",
]

# ---- fixed values: model feature set (23 base features) ----
MODEL_FEATURES = [
    "applicant_credit_score_type", "preapproval", "debt_to_income_ratio",
    "loan_amount", "loan_purpose", "lien_status", "loan_term",
    "loan_to_value_ratio", "reverse_mortgage", "open-end_line_of_credit",
    "manufactured_home_secured_property_type",
    "manufactured_home_land_property_interest", "prepayment_penalty_term",
    "intro_rate_period", "derived_race", "derived_dwelling_category",
    "applicant_age", "co-applicant_age", "co-applicant_sex",
    "co-applicant_sex_observed", "co-applicant_ethnicity_observed",
    "tract_to_msa_income_percentage", "ffiec_msa_md_median_family_income",
]
MODEL_CATEGORICAL = ["derived_race", "derived_dwelling_category", "applicant_age", "co-applicant_age"]
DEMOGRAPHIC_COLUMNS = [
    "derived_race", "applicant_age", "co-applicant_age", "co-applicant_sex",
    "co-applicant_sex_observed", "co-applicant_ethnicity_observed",
]
# columns dropped before feature selection (leakage / identifiers)
SELECTION_DROP = [
    "action_taken", "interest_rate", "rate_spread", "total_loan_costs",
    "origination_charges", "total_points_and_fees", "discount_points",
    "lender_credits", "denial_reason-1", "denial_reason-2",
    "denial_reason-3", "denial_reason-4", "hoepa_status",
    "purchaser_type", "initially_payable_to_institution",
    "aus-1", "aus-2", "aus-3", "aus-4", "aus-5",
    "lei", "census_tract", "state_code", "derived_msa-md",
    "activity_year", "year",
]

# ---- fixed values: decision thresholds of the three models ----
RF_THRESHOLD = 0.596
GBT_THRESHOLD = 0.500
FAIR_THRESHOLD = 0.570

# ---- fixed values: lender thresholds ----
MIN_WHITE_BLACK = 100
MIN_ASIAN_NATIVE = 30
MIN_APPS = 100

# ---- fixed values: recommendation config per applicant group
#      (gap column, rate column, count column, minimum count) ----
RECOMMEND_CONFIG = {
    "Black or African American": ("black_gap", "black_rate", "black_count", 100),
    "Asian": ("asian_gap", "asian_rate", "asian_count", 30),
    "American Indian or Alaska Native": ("native_gap", "native_rate", "native_count", 30),
    "Native Hawaiian or Other Pacific Islander": ("native_gap", "native_rate", "native_count", 30),
}

# ---- fixed values: postal bounding box of the state ----
STATE_BBOX = (-84.5, 33.5, -75.0, 36.8)
STATE_FIPS = "37"
STATE_REGION = "US-NC"

# ---- fixed values: county FIPS code → county name (state 37) ----
COUNTY_NAMES = {
    "37001": "Alamance", "37003": "Alexander", "37005": "Alleghany", "37007": "Anson",
    "37009": "Ashe", "37011": "Avery", "37013": "Beaufort", "37015": "Bertie",
    "37017": "Bladen", "37019": "Brunswick", "37021": "Buncombe", "37023": "Burke",
    "37025": "Cabarrus", "37027": "Caldwell", "37029": "Camden", "37031": "Carteret",
    "37033": "Caswell", "37035": "Catawba", "37037": "Chatham", "37039": "Cherokee",
    "37041": "Chowan", "37043": "Clay", "37045": "Cleveland", "37047": "Columbus",
    "37049": "Craven", "37051": "Cumberland", "37053": "Currituck", "37055": "Dare",
    "37057": "Davidson", "37059": "Davie", "37061": "Duplin", "37063": "Durham",
    "37065": "Edgecombe", "37067": "Forsyth", "37069": "Franklin", "37071": "Gaston",
    "37073": "Gates", "37075": "Graham", "37077": "Granville", "37079": "Greene",
    "37081": "Guilford", "37083": "Halifax", "37085": "Harnett", "37087": "Haywood",
    "37089": "Henderson", "37091": "Hertford", "37093": "Hoke", "37095": "Hyde",
    "37097": "Iredell", "37099": "Jackson", "37101": "Johnston", "37103": "Jones",
    "37105": "Lee", "37107": "Lenoir", "37109": "Lincoln", "37111": "McDowell",
    "37113": "Macon", "37115": "Madison", "37117": "Martin", "37119": "Mecklenburg",
    "37121": "Mitchell", "37123": "Montgomery", "37125": "Moore", "37127": "Nash",
    "37129": "New Hanover", "37131": "Northampton", "37133": "Onslow", "37135": "Orange",
    "37137": "Pamlico", "37139": "Pasquotank", "37141": "Pender", "37143": "Perquimans",
    "37145": "Person", "37147": "Pitt", "37149": "Polk", "37151": "Randolph",
    "37153": "Richmond", "37155": "Robeson", "37157": "Rockingham", "37159": "Rowan",
    "37161": "Rutherford", "37163": "Sampson", "37165": "Scotland", "37167": "Stanly",
    "37169": "Stokes", "37171": "Surry", "37173": "Swain", "37175": "Transylvania",
    "37177": "Tyrrell", "37179": "Union", "37181": "Vance", "37183": "Wake",
    "37185": "Warren", "37187": "Washington", "37189": "Watauga", "37191": "Wayne",
    "37193": "Wilkes", "37195": "Wilson", "37197": "Yadkin", "37199": "Yancey",
}

YEARS = [2019, 2020, 2021, 2022, 2023, 2024]
