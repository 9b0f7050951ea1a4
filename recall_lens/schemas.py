"""Column contracts of the feed tables.

A column is written NAME, NAME:width for text of bounded width, or NAME:date.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the adverse-event feed, in file order.
MAUDE = """
MDR_REPORT_KEY EVENT_KEY REPORT_NUMBER REPORT_SOURCE_CODE MANUFACTURER_LINK_FLAG_ NUMBER_DEVICES_IN_EVENT
NUMBER_PATIENTS_IN_EVENT DATE_RECEIVED:date ADVERSE_EVENT_FLAG PRODUCT_PROBLEM_FLAG DATE_REPORT:date
DATE_OF_EVENT:date REPROCESSED_AND_REUSED_FLAG REPORTER_OCCUPATION_CODE HEALTH_PROFESSIONAL INITIAL_REPORT_TO_FDA
DATE_FACILITY_AWARE:date REPORT_DATE:date REPORT_TO_FDA DATE_REPORT_TO_FDA:date EVENT_LOCATION
DATE_REPORT_TO_MANUFACTURER:date MANUFACTURER_CONTACT_T_NAME MANUFACTURER_CONTACT_F_NAME
MANUFACTURER_CONTACT_L_NAME MANUFACTURER_CONTACT_STREET_1 MANUFACTURER_CONTACT_STREET_2 MANUFACTURER_CONTACT_CITY
MANUFACTURER_CONTACT_STATE MANUFACTURER_CONTACT_ZIP_CODE MANUFACTURER_CONTACT_ZIP_EXT MANUFACTURER_CONTACT_COUNTRY
MANUFACTURER_CONTACT_POSTAL MANUFACTURER_CONTACT_AREA_CODE MANUFACTURER_CONTACT_EXCHANGE
MANUFACTURER_CONTACT_PHONE_NO MANUFACTURER_CONTACT_EXTENSION MANUFACTURER_CONTACT_PCOUNTRY
MANUFACTURER_CONTACT_PCITY MANUFACTURER_CONTACT_PLOCAL MANUFACTURER_G1_NAME MANUFACTURER_G1_STREET_1
MANUFACTURER_G1_STREET_2 MANUFACTURER_G1_CITY MANUFACTURER_G1_STATE_CODE MANUFACTURER_G1_ZIP_CODE
MANUFACTURER_G1_ZIP_CODE_EXT MANUFACTURER_G1_COUNTRY_CODE MANUFACTURER_G1_POSTAL_CODE
DATE_MANUFACTURER_RECEIVED:date DEVICE_DATE_OF_MANUFACTURE:date SINGLE_USE_FLAG REMEDIAL_ACTION PREVIOUS_USE_CODE
REMOVAL_CORRECTION_NUMBER EVENT_TYPE DISTRIBUTOR_NAME DISTRIBUTOR_ADDRESS_1 DISTRIBUTOR_ADDRESS_2 DISTRIBUTOR_CITY
DISTRIBUTOR_STATE_CODE DISTRIBUTOR_ZIP_CODE DISTRIBUTOR_ZIP_CODE_EXT REPORT_TO_MANUFACTURER MANUFACTURER_NAME
MANUFACTURER_ADDRESS_1 MANUFACTURER_ADDRESS_2 MANUFACTURER_CITY MANUFACTURER_STATE_CODE MANUFACTURER_ZIP_CODE
MANUFACTURER_ZIP_CODE_EXT MANUFACTURER_COUNTRY_CODE MANUFACTURER_POSTAL_CODE TYPE_OF_REPORT SOURCE_TYPE
DATE_ADDED:date DATE_CHANGED:date REPORTER_COUNTRY_CODE PMA_PMN_NUM EXEMPTION_NUMBER SUMMARY_REPORT NOE_SUMMARIZED
SUPPL_DATES_FDA_RECEIVED:date SUPPL_DATES_MFR_RECEIVED:date
"""

# Columns of the clearance feed.
PREMARKET_510K = """
KNUMBER:20 APPLICANT:500 CONTACT:500 STREET1:500 STREET2:500 CITY:255 STATE:50 COUNTRY_CODE:50 ZIP:20
POSTAL_CODE:20 DATERECEIVED:date DECISIONDATE:date DECISION:255 REVIEWADVISECOMM:100 PRODUCTCODE:50 STATEORSUMM
CLASSADVISECOMM:100 SSPINDICATOR:20 TYPE:50 THIRDPARTY:50 EXPEDITEDREVIEW:50 DEVICENAME:1000
"""

# Columns of the approval feed.
PMA = """
PMANUMBER:20 SUPPLEMENTNUMBER:20 APPLICANT:500 STREET_1:500 STREET_2:500 CITY:255 STATE:50 ZIP:20 ZIP_EXT:10
GENERICNAME:500 TRADENAME:500 PRODUCTCODE:50 ADVISORYCOMMITTEE:255 SUPPLEMENTTYPE:100 SUPPLEMENTREASON
REVIEWGRANTEDYN:5 DATERECEIVED:date DECISIONDATE:date DOCKETNUMBER:50 FEDREGNOTICEDATE:date DECISIONCODE:50
AOSTATEMENT
"""

# Columns of the product-code dimension.
PRODUCT_CODE = """
REVIEW_PANEL:100 MEDICALSPECIALTY:100 PRODUCTCODE:50 DEVICENAME DEVICECLASS:20 UNCLASSIFIED_REASON:255
GMPEXEMPTFLAG:10 THIRDPARTYFLAG:10 REVIEWCODE:20 REGULATIONNUMBER:50 SUBMISSION_TYPE_ID:20 DEFINITION PHYSICALSTATE
TECHNICALMETHOD TARGETAREA Implant_Flag:10 Life_Sustain_support_flag:10 SummaryMalfunctionReporting:10
"""

# Columns of the recall feed; k_numbers and openfda are nested in the source.
RECALL = """
cfres_id:255 product_res_number:255 event_date_initiated:date event_date_posted:date recall_status:255
res_event_number:255 product_code:255 k_numbers:255 product_description code_info recalling_firm address_1 address_2
city state postal_code additional_info_contact reason_for_recall root_cause_description action product_quantity
distribution_pattern openfda
"""

# Columns of the published score table and their types.
DEVICE_RPSS = T.StructType(
    [
        T.StructField("PMA_PMN_NUM", T.StringType()),
        T.StructField("rpss", T.DoubleType()),
        T.StructField("rpss_category", T.StringType()),
        T.StructField("recall_count", T.LongType()),
        T.StructField("total_adverse_events", T.LongType()),
        T.StructField("unique_manufacturers", T.LongType()),
        T.StructField("device_class", T.DoubleType()),
        T.StructField("root_cause_description", T.StringType()),
        T.StructField("last_scored", T.TimestampNTZType()),
    ]
)

WIDTH = "max_length"


def table_schema(columns: str) -> T.StructType:
    """The typed table: dates as dates, all else text with its width in the field's metadata."""
    fields = []
    for entry in columns.split():
        name, _, kind = entry.partition(":")
        if kind == "date":
            fields.append(T.StructField(name, T.DateType()))
        else:
            fields.append(T.StructField(name, T.StringType(), metadata={WIDTH: int(kind)} if kind else {}))
    return T.StructType(fields)


TABLES = {
    "maude": table_schema(MAUDE),
    "maude_mm": table_schema(MAUDE),
    "premarket_510k": table_schema(PREMARKET_510K),
    "pma": table_schema(PMA),
    "product_code": table_schema(PRODUCT_CODE),
    "recall": table_schema(RECALL),
    "device_rpss": DEVICE_RPSS,
}

# Columns that take part in joins.
KEYS = {
    "maude": ("PMA_PMN_NUM",),
    "maude_mm": ("PMA_PMN_NUM",),
    "premarket_510k": ("KNUMBER", "PRODUCTCODE"),
    "pma": ("PMANUMBER", "PRODUCTCODE"),
    "product_code": ("PRODUCTCODE",),
    "recall": ("product_code",),
}


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns as they stand in a text file."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def widths(schema: T.StructType) -> dict[str, int | None]:
    """Text columns and their width; None is unbounded."""
    return {f.name: f.metadata.get(WIDTH) for f in schema if isinstance(f.dataType, T.StringType)}


def dates(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.DateType)]
