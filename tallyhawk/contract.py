"""Fixed values of the data contract.

Everything in this module is a literal that must equal the behaviour being
reproduced: the field allowlist, canonical aliases, label sources, forbidden
column words, presets, risk bands, feature labels and patterns. Code elsewhere
reads these as data; nothing here touches a DataFrame.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: field allowlist.
# (path, action, tier, sensitive) for every field a code path reads.
# Actions: KEEP feature, DERIVE feeds a computed feature, HASH pseudonymised
# join key, META pipeline logic only, LABEL builds the target.
# ---------------------------------------------------------------------------
TRANSFER_FIELDS = [
    ("_id", "HASH", 1, False),
    ("user_id", "HASH", 1, False),
    ("recipient_id", "HASH", 1, False),
    ("send_amount", "KEEP", 1, False),
    ("amount_paid", "META", 1, False),
    ("transfer_fee", "KEEP", 1, False),
    ("rate", "KEEP", 1, False),
    ("discount", "KEEP", 1, False),
    ("sending_currency", "KEEP", 1, False),
    ("receiving_currency", "KEEP", 1, False),
    ("sending_from", "KEEP", 1, False),
    ("sending_to", "KEEP", 1, False),
    ("delivery_method", "KEEP", 1, False),
    ("recipient_acct_type", "KEEP", 1, False),
    ("recipient_network", "KEEP", 1, False),
    ("recipient_bank_name", "KEEP", 1, False),
    ("payment_method", "KEEP", 1, False),
    ("paymentProvider", "KEEP", 1, False),
    ("source", "KEEP", 1, False),
    ("description_code", "KEEP", 1, False),
    ("network_name", "KEEP", 1, False),
    ("avs_code", "KEEP", 1, False),
    ("risk_score", "KEEP", 1, False),
    ("verifiedStatus3Ds", "KEEP", 1, False),
    ("isEnabled3Ds", "DERIVE", 1, False),
    ("isChallenged3Ds", "KEEP", 1, False),
    ("authenticationStatus3Ds", "KEEP", 1, False),
    ("determine3dsResult.shouldChallenge", "KEEP", 1, False),
    ("determine3dsResult.attemptNo3ds", "KEEP", 1, False),
    ("is_recipient_changed", "KEEP", 1, False),
    ("previous_recipient", "DERIVE", 1, False),
    ("ipDetails.ip", "DERIVE", 1, True),
    ("ipDetails.security.vpn", "KEEP", 1, False),
    ("ipDetails.security.proxy", "KEEP", 1, False),
    ("ipDetails.security.tor", "KEEP", 1, False),
    ("ipDetails.security.relay", "KEEP", 1, False),
    ("ipDetails.location.country_code", "KEEP", 1, False),
    ("ipDetails.location.city", "KEEP", 1, False),
    ("ipDetails.location.country", "DERIVE", 1, False),
    ("ipDetails.network.autonomous_system_number", "KEEP", 1, False),
    ("sender_email", "DERIVE", 1, True),
    ("date", "META", 1, False),
]

USER_FIELDS = [
    ("_id", "HASH", 1, False),
    ("dateCreated", "DERIVE", 1, False),
    ("dob", "DERIVE", 1, True),
    ("isBusinessAccount", "KEEP", 1, False),
    ("signup_country", "KEEP", 1, False),
    ("occupation", "KEEP", 1, False),
    ("sender_type", "KEEP", 1, False),
    ("threshold_level_no", "KEEP", 2, False),
    ("threshold_level", "DERIVE", 2, False),
    ("remainingBalance", "DERIVE", 2, False),
    ("country", "KEEP", 2, False),
    ("phone_carrier_type", "KEEP", 2, False),
    ("is_phone_verified", "KEEP", 2, False),
    ("isVerified", "KEEP", 2, False),
    ("proof_of_funds_verification_status", "KEEP", 2, False),
    ("addressChangeCounter", "KEEP", 2, False),
    ("cardDeletionCounter", "KEEP", 2, False),
    ("isDocumentExpired", "KEEP", 2, False),
    ("pinFailedAttemptsCount", "KEEP", 2, False),
    ("isPinLocked", "KEEP", 2, False),
    ("billing_address", "DERIVE", 2, True),
]

RECIPIENT_FIELDS = [
    ("_id", "HASH", 1, False),
    ("user_id", "HASH", 1, False),
    ("date_created", "DERIVE", 1, False),
    ("country", "KEEP", 1, False),
    ("account_type", "KEEP", 1, False),
    ("bank_name", "KEEP", 1, False),
    ("payoutPartner", "KEEP", 1, False),
    ("relationship", "KEEP", 2, False),
    ("status", "KEEP", 2, False),
    ("recipient_email", "DERIVE", 1, True),
]

FLAG_FIELDS = [
    ("transfer", "HASH", 1, False),
    ("action", "LABEL", 1, False),
    ("date", "META", 1, False),
]

# FIXED VALUES: fields listed as excluded (never read; known to the profile).
TRANSFER_DROPPED = [
    "equivalent_send_amount", "receive_amount", "amount_converted", "equivalent_transfer_fee",
    "description", "ipDetails.location.latitude", "ipDetails.location.longitude", "status",
    "payment_status", "payment_partner_status", "payout_partner_status", "isPendingPayment", "flag_status",
    "date_flagged", "retry", "retry_receipt_number", "paymentWebhooks", "payoutWebhooks",
    "paymentWebhookProcessed", "payoutWebhookProcessed", "omnexPayoutReceiveEvent", "isHoldMailSent",
    "sender_name", "sender_phone_number", "recipient_name", "recipient_phone_number",
    "recipient_phone_number_intl", "recipient_account_number", "last_account_num", "paymentLinkUrl",
    "receiptUrl", "payout_callback_url", "relationship", "sourceOfFunds", "referral_redeemed",
    "referral_code", "receipt_number", "recipient_bank_code", "scenarioId", "licensorHolder",
    "isDowngraded3Ds", "nmi3dsData", "ach_type", "interchange_type", "omnexCalculateTransferResult",
    "ignorePartnerProvider", "socketID", "account_id", "sender_id", "pst_created_date",
]
USER_DROPPED = [
    "ssn", "password", "pin", "passwordResetToken", "plaid_income_user_token", "plaid_asset_report_token",
    "notification_token", "email", "emails", "full_name", "first_name", "last_name", "names",
    "phone_number", "phone_numbers", "addresses", "address", "state_id_num", "ip_address", "flag_status",
    "date_flagged", "isMonitored", "date_monitored", "flag_exempt", "flag_exemptions", "avs_exempt",
    "card_deletion_limit_exempt", "aml_ctf_status", "accountVerified", "emailVerified",
    "proof_of_funds_verification", "threshold_monthly_levels", "threshold_six_months_levels",
    "threshold_fifteen_days_level", "threshold_two_months_levels", "previousThreshold", "customer_id",
    "isPayoutRequestPending", "stateId", "licensor", "acceptTerms", "isBusinessFormCompleted",
    "activateMigrationPrompt", "forcePlaidRegistration", "isProofOfFundsReset", "currentDeviceBuildNumber",
    "currentDeviceInfo", "isLimitNotificationPromptActivated",
]
RECIPIENT_DROPPED = [
    "recipient_id", "account_number", "phone_number", "phone_number_intl", "name", "recipient_first_name",
    "recipient_last_name", "recipient_city", "bank_code", "flag_status", "isDelete", "relationship_id",
    "omnexRelationshipId", "externalIds", "externalBankDetails", "externalPhoneDetails",
]
FLAG_DROPPED = ["admin", "reason", "user", "recipient", "isActive"]

CONTRACTS = {
    "transfer": TRANSFER_FIELDS,
    "user": USER_FIELDS,
    "recipient": RECIPIENT_FIELDS,
    "flag": FLAG_FIELDS,
}
DROPPED = {
    "transfer": TRANSFER_DROPPED,
    "user": USER_DROPPED,
    "recipient": RECIPIENT_DROPPED,
    "flag": FLAG_DROPPED,
}

# FIXED VALUES: canonical provider-variant fields, first non-null alias wins.
CANONICAL = {
    "partner_reference": ["omnexPaymentId", "payment_receipt_number", "transaction_id"],
    "partner_txn_id": ["omnexPaymentMtn", "transaction_id"],
}

# FIXED VALUES: discriminators for the schema-variance profile.
DISCRIMINATORS = ["paymentProvider", "delivery_method", "recipient_acct_type", "source"]

# FIXED VALUES: sensitive derivations made at read time.
# field -> output column (None: written nowhere).
SENSITIVE_DERIVE = {
    "sender_email": "sender_email_domain",
    "recipient_email": "recipient_email_domain",
    "ipDetails.ip": None,
    "billing_address": "_raw_billing_address",
}

# FIXED VALUES: label sources.
SOURCE_CHARGEBACK = "confirmed_fraud_chargeback"
SOURCE_UPHELD = "confirmed_fraud_upheld"
SOURCE_CLEARED = "confirmed_legit_reviewed"
SOURCE_ASSUMED = "assumed_legit_never_flagged"

# FIXED VALUES: velocity windows (hours) and description-code rule.
VELOCITY_WINDOWS_HOURS = (1, 24, 168)
OBJECTID_PATTERN = "(?i)^[0-9a-f]{24}$"
LEGACY_RATE_ALERT = 0.5

# FIXED VALUES: cost-model defaults.
FP_UNIT_COST = 25.0
FN_LOSS_FRACTION = 1.0
FN_FIXED_COST = 0.0
COST_GRID_FP = [5, 10, 15, 20, 25, 30, 40, 50, 75, 100, 150, 200]

# FIXED VALUES: aggressiveness presets (name, multiplier), in report order.
PRESETS = [
    ("very_aggressive", 0.25),
    ("aggressive", 0.5),
    ("balanced", 1.0),
    ("cautious", 2.0),
    ("very_cautious", 4.0),
]
DEFAULT_PRESET = "balanced"
FP_OPS_COST = 15.0
FP_CHURN_PROB = 0.05
FP_CLV_MONTHS = 12.0
FP_VOLUME_MULTIPLE = 1.0
CHURN_MIN_CASES = 30
CHURN_CAP = 0.5
CHURN_HORIZON_DAYS = 90
DAYS_PER_MONTH = 30.44

# FIXED VALUES: advisory risk bands (lower cut, name), highest first.
RISK_BANDS = [(0.85, "Critical"), (0.50, "High"), (0.15, "Elevated"), (0.0, "Low")]
MIN_FEATURE_COVERAGE = 0.5

# FIXED VALUES: model-matrix policy.
METADATA_COLS = ["label", "label_source", "date", "amount_paid"]
FREQ_THRESHOLD = 20
DROP_ORIGINAL_ABOVE = 200
TEST_FRAC = 0.20
VAL_FRAC = 0.15

# FIXED VALUES: chargeback sheet header aliases (logical name -> aliases,
# matched as substrings of the normalised header, alias order first).
COLUMN_ALIASES = {
    "folio": ["folio", "folio (trnx id at jupay)", "trnx id at jupay",
              "common id", "partner_reference"],
    "partner_txn": ["unique trnx id", "trnx id", "partner txn id", "unique trnx id @mtn"],
    "amount": ["amount", "chargeback amount"],
    "principal": ["sending_principal", "sending principal"],
    "sending_date": ["sending_date", "sending date"],
    "rb_date": ["rb_date", "rb date", "chargeback date"],
    "observations": ["observations // patterns", "observations", "patterns", "notes"],
    "reason_code": ["reason_code", "reason code", "error code"],
    "watchlist": ["watch list / wl", "watchlist", "wl"],
}

# FIXED VALUES: fraud typology from free text, first match wins.
TYPOLOGY_PATTERNS = [
    ("stolen_card", r"stolen card|lost card|card.*stolen"),
    ("no_authorization", r"no cardholder auth|unauthori[sz]ed"),
    ("friendly_fraud", r"friendly fraud|first.?party|not recogni[sz]ed"),
    ("account_takeover", r"account takeover|ato\b|compromised account"),
    ("synthetic_identity", r"no id in system|new customer.*no id|synthetic"),
    ("scam_app", r"scam|romance|impersonat|social engineer"),
]

# FIXED VALUES: safety gate word lists.
FORBIDDEN_SUBSTRINGS = [
    "ssn", "password", "passwordreset", "pin", "token", "secret",
    "first_name", "last_name", "full_name", "sender_name", "recipient_name",
    "phone_number", "account_number", "last_account_num", "address",
    "email", "ip", "latitude", "longitude", "paymentlink", "receipturl", "callback",
    "state_id", "plaid",
]
ALLOWED_EXACT = {
    "sender_email_domain", "recipient_email_domain",
    "ip_country_mismatch",
    "ipDetails__security__vpn", "ipDetails__security__proxy",
    "ipDetails__security__tor", "ipDetails__security__relay",
    "ipDetails__location__country_code", "ipDetails__location__city",
    "ipDetails__network__autonomous_system_number",
    "billing_country_match",
    "user_addressChangeCounter", "user_pinFailedAttemptsCount",
    "user_isPinLocked",
}
IDENTITY_COLUMNS = {"_id", "user_id", "recipient_id", "_t",
                    "partner_reference", "partner_txn_id",
                    "user_user_id", "recipient_user_id"}
LEAKAGE_COLUMNS = {
    "status", "payment_status", "payment_partner_status", "payout_partner_status",
    "flag_status", "date_flagged", "isMonitored", "date_monitored",
    "flag_exempt", "avs_exempt", "retry", "isPendingPayment",
    "user_flag_status", "recipient_flag_status", "label_source_leak",
}
EXPECTED_METADATA_EXCLUSIONS = ["label", "label_source", "date", "amount_paid"]

# FIXED VALUES: readable feature labels and opaque prefixes.
FEATURE_LABELS = {
    "send_amount": "Transfer amount",
    "cents": "Amount pattern (round or unusual cents)",
    "transfer_fee": "Transfer fee",
    "rate": "Exchange rate",
    "sending_from": "Origin country",
    "sending_to": "Destination country",
    "sending_currency": "Sending currency",
    "receiving_currency": "Receiving currency",
    "delivery_method": "Payout method",
    "payment_method": "Funding method",
    "paymentProvider": "Payment provider",
    "source": "Channel (app or web)",
    "description_code": "Stated purpose of transfer",
    "network_name": "Card network",
    "avs_code": "Address verification result",
    "verifiedStatus3Ds": "3-D Secure result",
    "isChallenged3Ds": "3-D Secure challenge issued",
    "threeds_reported": "3-D Secure reported by provider",
    "ip_country_mismatch": "Sign-in location differs from stated origin",
    "ipDetails__security__vpn": "VPN detected",
    "ipDetails__security__proxy": "Proxy detected",
    "ipDetails__security__tor": "Tor network detected",
    "ipDetails__security__relay": "Relay detected",
    "ipDetails__location__country_code": "Sign-in country",
    "ipDetails__location__city": "Sign-in city",
    "ipDetails__network__autonomous_system_number": "Network provider",
    "sender_email_domain": "Sender email provider",
    "recipient_email_domain": "Recipient email provider",
    "hour": "Time of day",
    "weekday": "Day of week",
    "user_age_days": "Account age",
    "user_age_years": "Customer age",
    "recipient_age_days": "Recipient age (since added)",
    "is_first_send_to_recipient": "First transfer to this recipient",
    "prior_sends_to_recipient": "Previous transfers to this recipient",
    "is_recipient_changed": "Recipient changed late in the flow",
    "limit_utilisation": "Proportion of sending limit used",
    "billing_country_match": "Billing country matches account country",
    "user_threshold_level_no": "Account verification level",
    "user_phone_carrier_type": "Phone line type",
    "user_isVerified": "Identity verified",
    "user_isDocumentExpired": "Identity document expired",
    "user_isPinLocked": "Account PIN locked",
    "user_addressChangeCounter": "Recent address changes",
    "user_cardDeletionCounter": "Recent card removals",
    "user_country": "Account country",
    "user_signup_country": "Sign-up country",
    "user_occupation": "Stated occupation",
    "user_isBusinessAccount": "Business account",
    "recipient_country": "Recipient country",
    "recipient_relationship": "Stated relationship to recipient",
    "recipient_account_type": "Recipient account type",
    "recipient_doc_bank_name": "Recipient bank",
    "recipient_bank_name": "Recipient bank",
    "recipient_payoutPartner": "Payout partner",
    "recipient_status": "Recipient account status",
    "user_id_txn_1h": "Transfers in the past hour",
    "user_id_txn_24h": "Transfers in the past 24 hours",
    "user_id_txn_168h": "Transfers in the past week",
    "user_id_amt_1h": "Amount sent in the past hour",
    "user_id_amt_24h": "Amount sent in the past 24 hours",
    "user_id_amt_168h": "Amount sent in the past week",
}
OPAQUE_PREFIXES = ("V", "C", "D", "M", "id_")
FE_SUFFIX = "_FE"
FE_LABEL_SUFFIX = " (how common this value is)"
BEHAVIOURAL_PREFIX = "Behavioural signal "
