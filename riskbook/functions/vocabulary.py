"""Fixed values of the loan domain: column roles, status sets, bin edges and category orders."""

# --- Fixed values: column roles of the raw loan table -----------------------------------------

IDENTIFIERS = ("id", "member_id", "issue_d")

TEXT_AND_CONSTANTS = (
    "emp_title",
    "url",
    "title",
    "zip_code",
    "earliest_cr_line",
    "last_pymnt_d",
    "next_pymnt_d",
    "last_credit_pull_d",
    "policy_code",
)

MOSTLY_MISSING = (
    "desc",
    "mths_since_last_delinq",
    "mths_since_last_record",
    "mths_since_last_major_derog",
    "annual_inc_joint",
    "dti_joint",
    "verification_status_joint",
    "open_acc_6m",
    "open_il_6m",
    "open_il_12m",
    "open_il_24m",
    "mths_since_rcnt_il",
    "total_bal_il",
    "il_util",
    "open_rv_12m",
    "open_rv_24m",
    "max_bal_bc",
    "all_util",
    "inq_fi",
    "total_cu_tl",
    "inq_last_12m",
)

STATUS = "loan_status"

KNOWN_ONLY_AFTER_ORIGINATION = (
    "out_prncp",
    "out_prncp_inv",
    "total_pymnt",
    "total_pymnt_inv",
    "total_rec_prncp",
    "total_rec_int",
    "total_rec_late_fee",
    "recoveries",
    "collection_recovery_fee",
    "last_pymnt_amnt",
    "collections_12_mths_ex_med",
    "acc_now_delinq",
    "tot_coll_amt",
    "tot_cur_bal",
    "total_rev_hi_lim",
)

NUMERIC_FEATURES = (
    "loan_amnt",
    "funded_amnt",
    "funded_amnt_inv",
    "int_rate",
    "installment",
    "annual_inc",
    "dti",
    "delinq_2yrs",
    "inq_last_6mths",
    "open_acc",
    "pub_rec",
    "revol_bal",
    "revol_util",
    "total_acc",
)

TWO_VALUED_CATEGORIES = ("term", "initial_list_status", "application_type", "pymnt_plan")

MANY_VALUED_CATEGORIES = (
    "grade",
    "sub_grade",
    "home_ownership",
    "verification_status",
    "purpose",
    "addr_state",
)

ORDINAL_CATEGORY = "emp_length"

ANALYSIS_COLUMNS = ("issue_d_dateType", "issue_year", "annual_inc_range", "int_rate_range")

RAW_COLUMNS = (
    IDENTIFIERS
    + TEXT_AND_CONSTANTS
    + MOSTLY_MISSING
    + (STATUS,)
    + KNOWN_ONLY_AFTER_ORIGINATION
    + NUMERIC_FEATURES
    + TWO_VALUED_CATEGORIES
    + MANY_VALUED_CATEGORIES
    + (ORDINAL_CATEGORY,)
)

# --- Fixed values: loan statuses --------------------------------------------------------------

DEFAULT = "Default"
CHARGED_OFF = "Charged Off"
FULLY_PAID = "Fully Paid"
IN_GRACE = "In Grace Period"
LATE_SHORT = "Late (16-30 days)"
LATE_LONG = "Late (31-120 days)"
OFF_POLICY = "Does not meet the credit policy. Status:Charged Off"

# Three different notions of "defaulted"; they are not interchangeable.
DEFAULT_ONLY = (DEFAULT,)
TROUBLED = (DEFAULT, LATE_LONG, IN_GRACE, LATE_SHORT, OFF_POLICY)
LABELLED_BAD = (DEFAULT, CHARGED_OFF, LATE_LONG, LATE_SHORT, OFF_POLICY)

# Finished loans, whose missing balances are known to be zero.
SETTLED = (FULLY_PAID, CHARGED_OFF)

# --- Fixed values: bins, half-open [lower, next lower) ------------------------------------------

INCOME_EDGES = (
    -10_000,
    20_000,
    40_000,
    60_000,
    80_000,
    100_000,
    120_000,
    140_000,
    160_000,
    180_000,
    200_000,
    250_000,
    500_000,
    1_000_000,
    5_000_000,
)
INCOME_RANGES = (
    "0-20000",
    "20000-40000",
    "40000-60000",
    "60000-80000",
    "80000-100000",
    "100000-120000",
    "120000-140000",
    "140000-160000",
    "160000-180000",
    "180000-200000",
    "200000-250000",
    "250000-500000",
    "500000-1000000",
    "1000000-5000000",
)
INCOME_OTHER = ">5000000"

RATE_EDGES = (5, 7, 9, 11, 13, 15, 20, 25, 30)
RATE_RANGES = ("5-7%", "7-9%", "9-11%", "11-13%", "13-15%", "15-20%", "20-25%", "25-30%")
RATE_OTHER = ">30%"

# --- Fixed values: category orders ------------------------------------------------------------

INCOME_ORDER = INCOME_RANGES + (INCOME_OTHER,)
RATE_ORDER = RATE_RANGES + (RATE_OTHER,)
GRADE_ORDER = tuple("ABCDEFG")
SUB_GRADE_ORDER = tuple(f"{grade}{step}" for grade in GRADE_ORDER for step in range(1, 6))
EMP_LENGTH_YEARS = {
    "< 1 year": 0,
    "1 year": 1,
    **{f"{n} years": n for n in range(2, 10)},
    "10+ years": 10,
}
EMP_LENGTH_ORDER = ("n/a",) + tuple(EMP_LENGTH_YEARS)

# --- Fixed values: modelling --------------------------------------------------------------------

PUBLISHED_BALANCE = 0.0735
SPLIT_SEED = 1395
