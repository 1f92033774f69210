"""Columns and types of every layer. Staging is all text; core is typed and constrained."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# -- staging: names only, every column is text ---------------------------------------

STAGING = {
    "users": (
        "id nni first_name last_name full_name gender birth_date ethnicity phone email wilaya_id "
        "wilaya_name moughataa_id moughataa_name profile_type kyc_level status device_type "
        "registration_date last_login created_at updated_at"
    ).split(),
    "accounts": (
        "id user_id account_number account_type account_type_label currency balance "
        "available_balance daily_limit monthly_limit status is_primary opened_date last_activity "
        "created_at updated_at"
    ).split(),
    "merchants": (
        "id code mcc name category_code category_label owner_first_name owner_last_name "
        "owner_full_name owner_gender owner_ethnicity phone email wilaya_id wilaya_name "
        "moughataa_id moughataa_name address latitude longitude commission_rate "
        "avg_transaction_min avg_transaction_max status registration_date created_at"
    ).split(),
    "agencies": (
        "id code name wilaya_id wilaya_name moughataa_id moughataa_name address latitude longitude "
        "phone email opening_hours status tier float_balance max_float license_number "
        "license_expiry created_at"
    ).split(),
    "transactions": (
        "id reference idempotency_key transaction_type transaction_type_label amount fee "
        "total_amount currency "
        "source_account_id source_account_number source_user_id source_user_name "
        "destination_account_id destination_account_number destination_user_id "
        "destination_user_name merchant_id merchant_code merchant_name agency_id agency_code "
        "agency_name agent_id agent_name status failure_reason balance_before balance_after "
        "node_id processing_node sequence_number channel device_type ip_address description "
        "transaction_date transaction_time created_at completed_at"
    ).split(),
    "wilayas": "id code name capital latitude longitude population economic_weight".split(),
    "tx_types": (
        "id code label description requires_destination requires_merchant requires_agency is_credit"
    ).split(),
    "categories": "id code mcc label description avg_min avg_max".split(),
}


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


# -- core and lookups: (column, type) ------------------------------------------------

CORE_TYPES = {
    "users": {
        "id": "bigint", "nni": "string", "phone": "string", "full_name": "string",
        "gender": "string", "birth_date": "date", "email": "string", "wilaya_id": "int",
        "status": "string", "registration_date": "timestamp_ntz", "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    "accounts": {
        "id": "bigint", "user_id": "bigint", "account_number": "string", "account_type": "string",
        "balance": "decimal(14,2)", "available_balance": "decimal(14,2)", "currency": "string",
        "daily_limit": "decimal(14,2)", "monthly_limit": "decimal(14,2)", "status": "string",
        "is_primary": "boolean", "opened_date": "date", "last_activity": "timestamp_ntz",
        "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
    },
    "merchants": {
        "id": "bigint", "code": "string", "name": "string", "category_code": "string",
        "wilaya_id": "int", "status": "string", "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    "agencies": {
        "id": "bigint", "code": "string", "name": "string", "wilaya_id": "int",
        "float_balance": "decimal(14,2)", "tier": "string", "license_number": "string",
        "status": "string", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
    },
    "transactions": {
        "id": "bigint", "reference": "string", "idempotency_key": "string",
        "transaction_type": "string", "amount": "decimal(14,2)", "fee": "decimal(14,2)",
        "total_amount": "decimal(14,2)", "currency": "string", "source_account_id": "bigint",
        "destination_account_id": "bigint", "merchant_id": "bigint", "agency_id": "bigint",
        "status": "string", "failure_reason": "string", "balance_before": "decimal(14,2)",
        "balance_after": "decimal(14,2)", "node_id": "string", "processing_node": "string",
        "sequence_number": "bigint", "channel": "string", "device_type": "string",
        "ip_address": "string", "description": "string", "transaction_date": "date",
        "transaction_time": "time", "created_at": "timestamp_ntz",
        "completed_at": "timestamp_ntz",
    },
}

LOOKUP_TYPES = {
    "wilayas": {
        "id": "int", "code": "string", "name": "string", "capital": "string",
        "latitude": "decimal(38,10)", "longitude": "decimal(38,10)", "population": "int",
        "economic_weight": "decimal(38,10)",
    },
    "tx_types": {
        "id": "int", "code": "string", "label": "string", "description": "string",
        "requires_destination": "boolean", "requires_merchant": "boolean",
        "requires_agency": "boolean", "is_credit": "boolean",
    },
    "categories": {
        "id": "int", "code": "string", "mcc": "int", "label": "string", "description": "string",
        "avg_min": "decimal(38,10)", "avg_max": "decimal(38,10)",
    },
}

# Lookup sizes, statuses, the currency, the bad merchant prefix and its repair.
LOOKUP_ROWS = {"wilayas": 15, "tx_types": 8, "categories": 13}
STATUSES = ("SUCCESS", "FAILED", "PENDING")
CURRENCY = "MRU"
BAD_PREFIX = "undefined "
CATEGORY_PREFIX = {
    "ALM": "Alimentation ",
    "RST": "Restaurant ",
    "TRN": "Transport ",
    "TEL": "Télécom ",
    "CRB": "Carburant ",
    "SAN": "Santé ",
    "HAB": "Habillement ",
    "ELC": "Électronique ",
    "BTP": "BTP ",
    "EDU": "Éducation ",
    "SRV": "Services ",
    "HTL": "Hôtellerie ",
    "AUT": "Autres ",
}

# The codes and texts written to the issue tables.
ANOMALIES = {
    "invalid_failed_balance": "FAILED transaction changed balance",
    "invalid_amount": "Amount must be greater than zero",
    "negative_balance": "Balance after transaction is negative",
}
CONFLICT = "idempotency_conflict"
QUARANTINE = {
    "missing_source_account": "Source account is missing or cannot be resolved",
    "missing_destination_account": "Destination account is missing or cannot be resolved",
    "missing_merchant": "PAY transaction requires a merchant_id",
    "missing_core_reference":
        "Transaction references a parent record that does not exist in core tables",
}
REQUIRED = {
    "missing_destination_account": ("requires_destination", "destination_account_id"),
    "missing_merchant": ("requires_merchant", "merchant_id"),
    "missing_agency": ("requires_agency", "agency_id"),
}


# -- constraints of core ----------------------------------------------------------------

@dataclass(frozen=True)
class TableRules:
    """The contract of one core table: keys, required columns, checks and parents."""

    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ("id",)
    checks: dict[str, str] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


CONSTRAINTS = {
    "users": TableRules(
        required=("id", "nni", "phone", "wilaya_id"),
        unique=("id", "nni"),
        checks={
            "nni_format": r"nni rlike '^[0-9]{10}\\z'",
            "phone_format": r"phone rlike '^\\+222[0-9]{8}\\z'",
        },
        parents={"wilaya_id": ("wilayas", "id")},
    ),
    "accounts": TableRules(
        required=("id", "user_id", "account_number", "account_type", "balance",
                  "available_balance", "currency", "daily_limit", "monthly_limit", "status",
                  "is_primary"),
        unique=("id", "account_number"),
        checks={
            "balance_non_negative": "balance >= 0",
            "available_balance_non_negative": "available_balance >= 0",
            "daily_limit_non_negative": "daily_limit >= 0",
            "monthly_limit_non_negative": "monthly_limit >= 0",
            "currency": "currency = 'MRU'",
        },
        parents={"user_id": ("users", "id")},
    ),
    "merchants": TableRules(
        required=("id", "code", "category_code", "wilaya_id"),
        unique=("id", "code"),
        parents={"category_code": ("categories", "code"), "wilaya_id": ("wilayas", "id")},
    ),
    "agencies": TableRules(
        required=("id", "code", "wilaya_id"),
        unique=("id", "code"),
        checks={"float_balance_non_negative": "float_balance >= 0"},
        parents={"wilaya_id": ("wilayas", "id")},
    ),
    "transactions": TableRules(
        required=("id", "reference", "idempotency_key", "transaction_type", "amount", "fee",
                  "currency", "source_account_id", "status", "balance_before", "balance_after"),
        unique=("id", "reference", "idempotency_key"),
        checks={
            "amount_positive": "amount > 0",
            "fee_non_negative": "fee >= 0",
            "balance_before_non_negative": "balance_before >= 0",
            "balance_after_non_negative": "balance_after >= 0",
            "currency": "currency = 'MRU'",
            "status": "status in ('SUCCESS', 'FAILED', 'PENDING')",
            "failed_balance_unchanged": "status <> 'FAILED' or balance_after = balance_before",
            "completed_after_created": "completed_at >= created_at",
        },
        parents={
            "transaction_type": ("tx_types", "code"),
            "source_account_id": ("accounts", "id"),
            "destination_account_id": ("accounts", "id"),
            "merchant_id": ("merchants", "id"),
            "agency_id": ("agencies", "id"),
        },
    ),
}
