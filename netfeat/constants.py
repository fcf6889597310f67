"""Constants of the network-feature job.

Everything between the two "fixed values" markers must stay exactly as it
is: the features are defined against these lists, and adding, removing or
re-spelling an entry changes results. They are kept in their original order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the policy lists the features are defined against)
# ---------------------------------------------------------------------------

# High-risk jurisdictions, ISO3 codes.
HIGH_RISK_COUNTRIES = (
    "ALB", "DZA", "ATA", "ATG", "ARG", "ARM", "BHS", "BHR", "BRB", "BLZ", "BEN", "BOL", "BES", "BFA", "CPV",
    "CHN", "HKG", "CIV", "CMR", "COL", "CRI", "CUB", "DJI", "DMA", "DOM", "ECU", "EGY", "SLV", "SWZ", "ETH",
    "GAB", "GMB", "GEO", "GHA", "GIB", "GTM", "GUY", "HND", "IND", "IDN", "IRN", "IRQ", "JAM", "JOR", "KHM",
    "LAO", "LBN", "LBR", "LBY", "LTU", "MAC", "MKD", "MDG", "MLT", "MDV", "MLI", "MRT", "MUS", "MEX", "MDA",
    "MNG", "MAR", "MOZ", "MMR", "NAM", "NPL", "NIC", "NER", "NGA", "OMN", "PAK", "PAN", "PER", "PHL", "QAT",
    "SAU", "SEN", "SRB", "SYC", "SLE", "SOM", "SSD", "LKA", "SDN", "SUR", "SYR", "TZA", "THA", "TGO", "TTO",
    "TUN", "TUR", "UGA", "UKR", "URY", "UZB", "VCT", "VEN", "VNM", "YEM", "ZAF", "ZMB",
)

# Very-high-risk jurisdictions, ISO3 codes ("DPRK" is four letters in the
# policy list and is kept as written).
VERY_HIGH_RISK_COUNTRIES = (
    "AFG", "AGO", "AZE", "BGD", "CAF", "TCD", "COM", "COD", "COG", "CUB", "DPRK", "ERI", "GIN", "GNB",
    "HTI", "IRN", "IRQ", "KEN", "KGZ", "LBN", "LBR", "LBY", "MDG", "MLI", "MOZ", "MMR", "NIC", "NGA", "PAK",
    "PSE", "RUS", "SOM", "SSD", "SDN", "SYR", "TJK", "TLS", "TUR", "UGA", "UKR", "UZB", "VEN", "YEM", "ZWE",
)

# Sanction-evasion jurisdictions, country name -> ISO3.
SANCTION_EVASION_COUNTRIES = {
    "Armenia": "ARM", "Azerbaijan": "AZE", "Belarus": "BLR", "China": "CHN",
    "Hong Kong": "HKG", "Kazakhstan": "KAZ", "Kyrgyzstan": "KGZ", "Malaysia": "MYS",
    "Moldova": "MDA", "Mongolia": "MNG", "Serbia": "SRB", "Thailand": "THA",
    "Turkey": "TUR", "United Arab Emirates": "ARE", "Uzbekistan": "UZB",
}

# Account-number prefixes that mark a risky account type.
RISKY_ACCOUNT_PREFIXES = ("NRA", "OSA", "FIN")

# Industry (SIC) codes excluded from scoring.
EXCLUDED_SIC_CODES = ("7389",)

# Ids that stand for "no entity" and never become graph vertices.
SENTINEL_IDS = ("9999", "NaN", "")

# Text that replaces a null id before the graph is built.
NULL_ID_TOKEN = "NaN"

# Text removed (everywhere in the value, not only at the start) from account ids.
ACCOUNT_PREFIX = "ACCT-"

# Account-id columns of a wire row that may carry ACCOUNT_PREFIX.
ACCOUNT_ID_COLUMNS = (
    "ORIG_REMITTER_ACCT_ID",
    "TP_ORIGIN_ACCT_ID",
    "TP_BENEF_ACCT_ID",
    "BENEF_ACCT_ID",
    "SENDING_INSTN_ACCT_ID",
    "RCV_INSTN_ACCT_ID",
)

# Party roles of a wire row: role -> {type column: (account, name, country) columns}.
WIRE_PARTY_COLUMNS = {
    "origin": {
        "TP_ORIGIN_TYPE": ("TP_ORIGIN_ACCT_ID", "TP_ORIGIN_NAME", "TP_ORIGIN_COUNTRY"),
        "ORIG_REMITTER_ID_TYPE": ("ORIG_REMITTER_ACCT_ID", "ORIG_REMITTER_NAME", "ORIG_REMITTER_COUNTRY"),
    },
    "benef": {
        "BENEF_TYPE": ("BENEF_ACCT_ID", "BENEF_NAME", "BENEF_COUNTRY"),
        "TP_BENEF_TYPE": ("TP_BENEF_ACCT_ID", "TP_BENEF_NAME", "TP_BENEF_COUNTRY"),
    },
}

# Columns of a wire (payment) row used before graph construction.
WIRE_COLUMNS = (
    "TRXN_REF_ID",
    "BENEF_ACCT_ID", "BENEF_CC_CD", "BENEF_COUNTRY", "BENEF_NAME", "BENEF_TYPE",
    "ORIG_REMITTER_ACCT_ID", "ORIG_REMITTER_AMT_ACTIVITY", "ORIG_REMITTER_CCY_CD",
    "ORIG_REMITTER_COUNTRY", "ORIG_REMITTER_NAME", "ORIG_REMITTER_ID_TYPE",
    "ORIG_REMITTER_TOD_TYPE", "POSTING_DATE",
    "RCV_INSTN_ACCT_ID", "RCV_INSTN_AMT_ACTIVITY", "RCV_INSTN_CCY_CD", "RCV_INSTN_COUNTRY",
    "RCV_INSTN_ID", "RCV_INSTN_NAME", "RCV_INSTN_TYPE",
    "SENDING_INSTN_ACCT_ID", "SENDING_INSTN_AMT_ACTIVITY", "SENDING_INSTN_CCY_CD",
    "SENDING_INSTN_COUNTRY", "SENDING_INSTN_ID", "SENDING_INSTN_NAME", "SENDING_INSTN_TYPE",
    "TP_BENEF_ACCT_ID", "TP_BENEF_CC_CD", "TP_BENEF_COUNTRY", "TP_BENEF_NAME", "TP_BENEF_TYPE",
    "TP_ORIGIN_ACCT_ID", "TP_ORIGIN_AMT_ACTIVITY", "TP_ORIGIN_CCY_CD", "TP_ORIGIN_COUNTRY",
    "TP_ORIGIN_NAME", "TP_ORIGIN_TYPE",
    "TRXN_AMOUNT", "TRXN_CURRENCY_CD", "TRXN_GROUP", "TRANSACTION_TYPE",
)

# Algorithm parameters of the feature set.
PAGERANK_RESET = 0.15
PAGERANK_ITERATIONS = 5
LABEL_PROPAGATION_ITERATIONS = 5
EIGENVECTOR_PLACEHOLDER = 0.5

# ---------------------------------------------------------------------------
# End of fixed values
# ---------------------------------------------------------------------------

# Look-back windows in months, one graph per (vintage, window).
DEFAULT_WINDOWS = (6, 12)

# Column names of the input tables.
ENTITY = "EXT_ENTITYID"
ENTITY_COUNTRIES = "combinedCountryCodes"
COUNTERPARTY = "COUNTER_PARTY_ENTITYID"
COUNTERPARTY_COUNTRIES = "COUNTER_PARTY_COMBINEDCOUNTRYCODES"
TRXN_REF = "TRXN_REF_ID"
VINTAGE = "VINTAGE_DT"
POSTING = "POSTING_DATE"
POSTING_MONTH = "POSTING_MONTH"  # optional partition column: first day of the month of POSTING_DATE
WINDOW = "window_m"

# Snapshot key columns carried through every batched operator.
SNAPSHOT_KEYS = (VINTAGE, WINDOW)

# Per-window feature columns, in output order (suffix "_{w}m" in the wide table).
CENTRALITY_COLUMNS = (
    "degree_centrality",
    "pagerank_centrality",
    "eigenvector_centrality",
    "community_size",
    "community_density",
    "average_degree",
    "network_size",
)
