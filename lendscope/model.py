"""The loan data model: columns, types, header aliases and other fixed values.

Everything in this module is data.  The tables below are fixed values: results
are only right when they hold exactly these entries.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(10, 4)

# The columns of the loans table, in table order.
LOAN_TYPES: dict[str, T.DataType] = {
    "as_of_date": T.DateType(),
    "program": T.StringType(),
    "loan_id": T.LongType(),
    "borrower_name": T.StringType(),
    "borrower_street": T.StringType(),
    "borrower_city": T.StringType(),
    "borrower_state": T.StringType(),
    "borrower_zip": T.StringType(),
    "lender_name": T.StringType(),
    "bank_fdic_number": T.StringType(),
    "bank_ncua_number": T.StringType(),
    "bank_street": T.StringType(),
    "bank_city": T.StringType(),
    "bank_state": T.StringType(),
    "bank_zip": T.StringType(),
    "cdc_name": T.StringType(),
    "cdc_street": T.StringType(),
    "cdc_city": T.StringType(),
    "cdc_state": T.StringType(),
    "cdc_zip": T.StringType(),
    "third_party_lender_name": T.StringType(),
    "third_party_lender_city": T.StringType(),
    "third_party_lender_state": T.StringType(),
    "third_party_dollars": MONEY,
    "loan_amount": MONEY,
    "sba_guaranteed_approval": MONEY,
    "approval_date": T.DateType(),
    "approval_fiscal_year": T.IntegerType(),
    "disbursement_date": T.DateType(),
    "processing_method": T.StringType(),
    "delivery_method": T.StringType(),
    "subprogram": T.StringType(),
    "initial_interest_rate": RATE,
    "fixed_or_variable_interest_ind": T.StringType(),
    "term_in_months": T.IntegerType(),
    "naics_code": T.StringType(),
    "naics_description": T.StringType(),
    "franchise_code": T.StringType(),
    "franchise_name": T.StringType(),
    "project_county": T.StringType(),
    "project_state": T.StringType(),
    "sba_district_office": T.StringType(),
    "congressional_district": T.StringType(),
    "business_type": T.StringType(),
    "business_age": T.StringType(),
    "loan_status": T.StringType(),
    "paid_in_full_date": T.DateType(),
    "charge_off_date": T.DateType(),
    "charge_off_amount": MONEY,
    "revolver_status": T.StringType(),
    "jobs_supported": T.IntegerType(),
    "collateral_ind": T.StringType(),
    "sold_secondary_market_ind": T.StringType(),
    "source_file": T.StringType(),
}

LOAN_COLUMNS = list(LOAN_TYPES)
LOAN_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in LOAN_TYPES.items()])
ROW_KEY = "loan_row_id"
SOURCE_FILE = "source_file"
# Where in its file a raw row is: file path, start of the piece, order in it.
POSITION = ("source_path", "block_start", "row_order")

DATE_COLUMNS = [c for c, t in LOAN_TYPES.items() if isinstance(t, T.DateType)]
DECIMAL_COLUMNS = [c for c, t in LOAN_TYPES.items() if isinstance(t, T.DecimalType)]
INTEGER_COLUMNS = [c for c, t in LOAN_TYPES.items() if isinstance(t, T.IntegerType)]

# Header spellings of the public extracts, reduced to lower-case
# letters and digits, and the column each one fills.  Headers not listed keep
# their snake_case form.
HEADER_ALIASES: dict[str, str] = {
    "asofdate": "as_of_date",
    "l2locid": "loan_id",
    "borrname": "borrower_name",
    "borrstreet": "borrower_street",
    "borrcity": "borrower_city",
    "borrstate": "borrower_state",
    "borrzip": "borrower_zip",
    "bankname": "lender_name",
    "bankfdicnumber": "bank_fdic_number",
    "bankncuanumber": "bank_ncua_number",
    "bankstreet": "bank_street",
    "bankcity": "bank_city",
    "bankstate": "bank_state",
    "bankzip": "bank_zip",
    "thirdpartylendername": "third_party_lender_name",
    "thirdpartylendercity": "third_party_lender_city",
    "thirdpartylenderstate": "third_party_lender_state",
    "thirdpartydollars": "third_party_dollars",
    "grossapproval": "loan_amount",
    "sbaguaranteedapproval": "sba_guaranteed_approval",
    "approvaldate": "approval_date",
    "approvalfiscalyear": "approval_fiscal_year",
    "firstdisbursementdate": "disbursement_date",
    "processingmethod": "processing_method",
    "deliverymethod": "delivery_method",
    "initialinterestrate": "initial_interest_rate",
    "fixedorvariableinterestind": "fixed_or_variable_interest_ind",
    "terminmonths": "term_in_months",
    "naicscode": "naics_code",
    "naicsdescription": "naics_description",
    "franchisecode": "franchise_code",
    "franchisename": "franchise_name",
    "projectcounty": "project_county",
    "projectstate": "project_state",
    "sbadistrictoffice": "sba_district_office",
    "congressionaldistrict": "congressional_district",
    "businesstype": "business_type",
    "businessage": "business_age",
    "loanstatus": "loan_status",
    "paidinfulldate": "paid_in_full_date",
    "chargeoffdate": "charge_off_date",
    "grosschargeoffamount": "charge_off_amount",
    "revolverstatus": "revolver_status",
    "jobssupported": "jobs_supported",
    "collateralind": "collateral_ind",
    "soldsecmrktind": "sold_secondary_market_ind",
}

# Cells that mean "no value" in a raw file (compared untrimmed).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# The cleaning scan also takes a single space for an empty cell.
CLEANING_NA_TOKENS = (*NA_TOKENS, " ")

# The characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The lender of a loan is the first of these that is known.
LENDER_SOURCES = ("lender_name", "third_party_lender_name", "cdc_name")

# Business sector of the first two digits of a NAICS code.
SECTORS: dict[str, str] = {
    "11": "Agriculture, Forestry, Fishing and Hunting",
    "21": "Mining, Quarrying, and Oil and Gas Extraction",
    "22": "Utilities",
    "23": "Construction",
    "31": "Manufacturing",
    "32": "Manufacturing",
    "33": "Manufacturing",
    "42": "Wholesale Trade",
    "44": "Retail Trade",
    "45": "Retail Trade",
    "48": "Transportation and Warehousing",
    "49": "Transportation and Warehousing",
    "51": "Information",
    "52": "Finance and Insurance",
    "53": "Real Estate and Rental and Leasing",
    "54": "Professional, Scientific, and Technical Services",
    "55": "Management of Companies and Enterprises",
    "56": "Administrative and Support Services",
    "61": "Educational Services",
    "62": "Health Care and Social Assistance",
    "71": "Arts, Entertainment, and Recreation",
    "72": "Accommodation and Food Services",
    "81": "Other Services",
    "92": "Public Administration",
}
UNKNOWN = "Unknown"
UNCLASSIFIED = "Other / Unclassified"

# Default thresholds and sizes; each is an argument where used.
PREVIEW_ROWS = 10_000
INSERT_BATCH_ROWS = 5_000
MIN_SECTOR_FUNDING = 50_000_000
MIN_STATE_FUNDING = 25_000_000
MIN_STATE_LOANS = 250
MIN_INDUSTRY_LOANS = 100
MIN_LENDER_LOANS = 100
TOP_INDUSTRIES = 20
TOP_RANKED = 10
RESULT_PREVIEW_ROWS = 3

# Words a guarded ad-hoc query may not contain.
BLOCKED_WORDS = (
    "insert", "update", "delete", "drop", "alter", "create", "grant", "copy",
    "truncate", "information_schema", "pg_catalog", "loans",
)
