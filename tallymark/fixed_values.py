"""Identifiers, codes, labels and layouts of the existing tables.

They are data, not logic; results only agree with the tables already in use
when they are kept exactly as they are.
"""

# Entity types of an account (type id -> label).
TYPE_LABELS = {
    9145485386913639391: "Customer Country",
    9145485386913639390: "Holding",
    9145485386913639400: "Legal Entity",
}

# Fixed value: relation type meaning "is parent of".
PARENT_OF = 9137799819213569275

# Product codes that belong to flagged customers.
FLAG_PRODUCT_CODES = [
    "CLOUD_DDOS",
    "CPE_DDOS",
    "ITS Resale",
    "ITS",
    "LOCAL_PLATFORM",
    "LOCAL_PLATFORM_FC",
    "MANAGED_DDOS",
    "Local Platform Final Customer",
]

# Fixed value: tax id prefix that marks a flagged customer.
FLAG_PREFIX = "ACCT"

# Names that stand for "no name".
BLANK_NAMES = [" -", "-", "--"]

# Decorated status endings and the pattern that undecorates them.
STATUS_RULES = [
    ("6#9BBB59$Active", r"[a-zA-z0-9«#$%&/()=*]*Active", "Active"),
    (
        "6#F5DF48$Pending Activation",
        r"[a-zA-z0-9«#$%&/()=*]*Pending Activation",
        "Pending Activation",
    ),
]

# States and record types used by the reconciliation.
LIVE_STATUSES = ["Active", "Pending Activation"]
ACTIVE_STATUS = "Active"
CLOSED_SERVICE_STATUSES = ["Disconnected"]
CRM_ACTIVE = "Sí"
CRM_EXCLUDED_TYPES = ["Business Unit", "Cost Center"]

# Control types written to the run log.
CONTROL_TYPES = {
    "matched_by_global_id": 52,
    "account_only": 53,
    "crm_only": 54,
    "matched_by_external_id": 92,
    "flagged_without_flag_services": 66,
    "unflagged_with_flag_services": 67,
    "shared_customers": 68,
    "holding": 108,
    "run_status": 39,
    "schema_size": 40,
    "table_size": 41,
}

# Fixed value: attribute keys stored with the four reconciliation runs.
RECONCILIATION_ATTRIBUTES = [11, 2, 357, 346]

# Fixed value: exception type whose rules force the duplicate mark.
FORCED_DUPLICATE_EXCEPTION = 2

# Marks in table names that keep a table out of the run status.
STATUS_SKIP_FRAGMENTS = ["arning", "EquipoPreventa"]
STATUS_SKIP_PREFIX = "Historico_"

# Catalog schemas and relation kinds that are not user tables.
CATALOG_SCHEMAS = ["pg_catalog", "information_schema"]
CATALOG_SCHEMA_PATTERN = "^pg_toast"
INDEX_KIND = "i"

# Labels of the reconciliation report (flag -> yes, no).
REPORT_LABELS = {
    "R1_1": ("SiR1_1", "NoR1_1"),
    "R1_2": ("SiR1_2", "NoR1_2"),
    "R1_3": ("SiR1_3", "NoR1_3"),
    "R1_4": ("SiR1_4", "NoR1_4"),
}

# Physical column names of the CRM extract, by logical name.
CRM_COLUMNS = {
    "NameSF": "Name",
    "crm_tax_id": "BI_No_Identificador_fiscal__c",
    "crm_parent_id": "ParentId",
    "crm_global_id": "BI_Id_del_cliente_BIEN__c",
    "crm_ext_id": "BI_Identificador_Externo__c",
    "record_type": "RecordType.Name",
    "active": "BI_Activo__c",
    "last_activity": "Last_Account_Activity__c",
}

# Physical column names of the run log, by logical name.
RUN_LOG_COLUMNS = {
    "run_key": "ClEjecControl",
    "attribute_key": "ClAtrTabSis",
    "control_type": "ClTipControl",
    "row_count": "NumRegistros",
    "attribute_keys": "ListaClAtrTabSis",
    "run_ts": "Fecha",
}

# Physical column names of the reconciliation result, in order.
RECONCILIATION_LAYOUT = {
    "NameSF": "NameSF",
    "crm_tax_id": "BI_No_Identificador_fiscal__c",
    "crm_parent_id": "ParentId",
    "crm_global_id": "BI_Id_del_cliente_BIEN__c",
    "crm_ext_id": "BI_Identificador_Externo__c",
    "record_type": "RecordType.Name",
    "active": "BI_Activo__c",
    "last_activity": "max(Last_Account_Activity__c)",
    "NAME": "NAME",
    "TAX_IDENT_NUMBER": "TAX_IDENT_NUMBER",
    "PARENT_ID": "PARENT_ID",
    "UNIQUE_GLOBAL_ID": "UNIQUE_GLOBAL_ID",
    "STATUS": "STATUS",
    "OBJECT_ID": "OBJECT_ID",
    "CUST_TYPE": "CUST_TYPE",
    "OBJECT_ID_BUS": "OBJECT_ID_BUS",
    "NAME_NC": "NAME_NC",
    "NAME_HOLDING": "NAME_HOLDING",
    "OBJECT_ID_HOLDING": "OBJECT_ID_HOLDING",
    "MODIFIED_WHEN": "max(MODIFIED_WHEN)",
    "svc_customer": "CUSTOMER_ACCOUNT_TOP",
    "n_svc": "Cant_Prod_Instances_active_planned",
    "ord_customer": "PARENT_ID_ORD",
    "n_ord": "Cant_Prod_Orders",
}

# Physical column names of the other results, by logical name.
SERVICE_RESULT_COLUMNS = {"n_services": "NumVecesServAsocAlCustomer_TOP"}
STATUS_COLUMNS = {"status": "OKNOK", "control": "ControlName"}
SCHEMA_SIZE_COLUMNS = {"size_gb": "SizeDBInGB"}
TABLE_SIZE_COLUMNS = {"size": "DSSize", "size_kb": "DSSizekBytes", "name": "DSName"}

# Physical column names of the wide holding pairs, in order.
HOLDING_PAIRS_LAYOUT = {
    "OBJECT_ID_HOLDING": "SC_HOLDING_OBJECT_ID",
    "NAME_HOLDING": "DS_HOLDING_NAME",
    "STATUS_HOLDING": "DS_HOLDING_STATUS",
    "IS_MNC_HOLDING": "DS_HOLDING_IS_MNC",
    "IS_OTT_HOLDING": "DS_HOLDING_IS_OTT",
    "ACRONYM_HOLDING": "DS_HOLDING_ACRONYM",
    "CUST_TYPE_NAME_HOLDING": "DS_HOLDING_CUST_TYPE",
    "OBJECT_ID_LE": "SC_LE_OBJECT_ID",
    "NAME_LE": "DS_LE_NAME",
    "STATUS_LE": "DS_LE_STATUS",
    "IS_MNC_LE": "DS_LE_IS_MNC",
    "IS_OTT_LE": "DS_LE_IS_OTT",
    "ACRONYM_LE": "DS_LE_ACRONYM",
    "CUST_TYPE_NAME_LE": "DS_LE_CUST_TYPE",
}
