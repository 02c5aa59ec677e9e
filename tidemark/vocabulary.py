"""Provider names, field lists, labels, aliases and feature names.

FIXED VALUES.  Everything in this file is data that the outputs must agree
with, not logic; it is listed in natural order.
"""

from __future__ import annotations

# --- provider and dataset ids ------------------------------------------------
SOURCE_FILINGS = "edinet_api_v2"
SOURCE_SERIES = "boj_timeseries"
SOURCE_CATALOG = "estat_api_v3"
SOURCE_MARKET = "jquants_v2"

# --- labels ------------------------------------------------------------------
CURRENT_YEAR_LABELS = (
    "currentyear", "current_year", "current", "0", "当期", "当期末", "当中間期", "当中間期末",
)
INSTANT_LABELS = ("instant", "時点")
DURATION_LABELS = ("duration", "期間")
CHANGE_REPORT_MARK = "変更報告書"
CORRECTION_MARK = "訂正"
CORRECTION_TYPE_CODE = "360"
MISSING_SERIES_VALUES = ("", "NA", "N/A")
PACKAGE_FACT_FOLDER = "xbrl_to_csv"

# --- document list: provider field -> column ---------------------------------
FILING_FIELDS = {
    "seqNumber": "seq_number",
    "docID": "doc_id",
    "edinetCode": "edinet_code",
    "secCode": "sec_code",
    "JCN": "jcn",
    "filerName": "filer_name",
    "fundCode": "fund_code",
    "ordinanceCode": "ordinance_code",
    "formCode": "form_code",
    "docTypeCode": "doc_type_code",
    "periodStart": "period_start",
    "periodEnd": "period_end",
    "submitDateTime": "submit_datetime",
    "docDescription": "doc_description",
    "issuerEdinetCode": "issuer_edinet_code",
    "subjectEdinetCode": "subject_edinet_code",
    "subsidiaryEdinetCode": "subsidiary_edinet_code",
    "currentReportReason": "current_report_reason",
    "parentDocID": "parent_doc_id",
    "opeDateTime": "operation_datetime",
    "withdrawalStatus": "withdrawal_status",
    "docInfoEditStatus": "doc_info_edit_status",
    "disclosureStatus": "disclosure_status",
    "xbrlFlag": "xbrl_flag",
    "pdfFlag": "pdf_flag",
    "attachDocFlag": "attach_doc_flag",
    "englishDocFlag": "english_doc_flag",
    "csvFlag": "csv_flag",
    "legalStatus": "legal_status",
}

# --- fact files: printed header -> column ------------------------------------
FACT_HEADERS = {
    "要素ID": "element_id",
    "項目名": "item_name",
    "コンテキストID": "context_id",
    "相対年度": "relative_year",
    "連結・個別": "consolidation",
    "期間・時点": "period_type",
    "ユニットID": "unit_id",
    "単位": "unit",
    "値": "value",
    "Element ID": "element_id",
    "Item Name": "item_name",
    "Context ID": "context_id",
    "Relative Year": "relative_year",
    "Consolidated/Non-consolidated": "consolidation",
    "Period/Instant": "period_type",
    "Unit ID": "unit_id",
    "Unit": "unit",
    "Value": "value",
}
FACT_COLUMNS = (
    "element_id", "item_name", "context_id", "relative_year", "consolidation",
    "period_type", "unit_id", "unit", "value",
)
REQUIRED_FACT_COLUMNS = ("element_id", "context_id", "value")

# --- document selection: category -> (type codes, priority, whether packages are fetched) ------------------
DOCUMENT_RULES = {
    "financial": (("120", "130", "140", "150", "160", "170"), 1, True),
    "event": (("180", "190"), 2, True),
    "buyback": (("220",), 2, True),
    "tender_offer": (("240", "250", "270", "280", "290", "300", "310", "320"), 2, True),
    "ownership": (("350", "360"), 1, True),
}
BACKFILL_PHASES = {
    "ownership": ("350", "360"),
    "financial_annual": ("120", "130"),
    "financial_periodic": ("140", "150", "160", "170"),
    "events_buyback": ("180", "190", "220"),
    "tender_offer": ("240", "250", "270", "280", "290", "300", "310", "320"),
}

# --- canonical metric -> element local names ---------------------------------
METRIC_ALIAS_VERSION = 5
METRIC_ALIASES = {
    "revenue": ("NetSales", "Revenue", "OperatingRevenue1", "OperatingRevenue", "Sales"),
    "operating_income": ("OperatingIncome", "OperatingProfitLoss", "OperatingProfit"),
    "ordinary_income": ("OrdinaryIncome",),
    "pretax_income": ("IncomeBeforeIncomeTaxes", "ProfitLossBeforeIncomeTaxes"),
    "net_income": (
        "ProfitLoss", "ProfitLossAttributableToOwnersOfParent", "ProfitAttributableToOwnersOfParent",
    ),
    "total_assets": ("Assets", "TotalAssets"),
    "total_liabilities": ("Liabilities", "TotalLiabilities"),
    "net_assets": ("NetAssets", "Equity"),
    "shareholders_equity": ("ShareholdersEquity",),
    "cash_and_deposits": ("CashAndDeposits", "CashAndCashEquivalents"),
    "interest_bearing_debt": ("InterestBearingDebt", "InterestBearingDebtCurrentAndNoncurrent"),
    "operating_cash_flow": ("NetCashProvidedByUsedInOperatingActivities",),
    "investing_cash_flow": (
        "NetCashProvidedByUsedInInvestingActivities",
        "NetCashProvidedByUsedInInvestmentActivities",
        "NetCashProvidedByUsedInInvestingActivitiesSummaryOfBusinessResults",
        "NetCashProvidedByUsedInInvestingActivitiesIFRS",
        "CashFlowsFromUsedInInvestingActivitiesIFRSSummaryOfBusinessResults",
    ),
    "financing_cash_flow": ("NetCashProvidedByUsedInFinancingActivities",),
    "depreciation": ("DepreciationAndAmortization", "Depreciation", "DepreciationAndAmortizationOpeCF"),
    "capital_expenditure": (
        "PurchaseOfPropertyPlantAndEquipmentAndIntangibleAssets",
        "PurchaseOfPropertyPlantAndEquipment",
        "CapitalExpendituresOverviewOfCapitalExpendituresEtc",
    ),
    "research_and_development": ("ResearchAndDevelopmentExpenses", "ResearchAndDevelopmentExpensesSGA"),
    "eps": (
        "BasicEarningsLossPerShare",
        "BasicEarningsPerShare",
        "BasicEarningsLossPerShareSummaryOfBusinessResults",
        "BasicEarningsLossPerShareIFRSSummaryOfBusinessResults",
        "BasicEarningsLossPerShareIFRS",
    ),
    "dividend_per_share": (
        "DividendPaidPerShare",
        "DividendPaidPerShareSummaryOfBusinessResults",
        "DividendPerShareDividendsOfSurplus",
    ),
    "shares_outstanding": (
        "TotalNumberOfIssuedSharesSummaryOfBusinessResults",
        "NumberOfIssuedSharesAsOfFiscalYearEndIssuedSharesTotalNumberOfSharesEtc",
    ),
    "income_tax": ("IncomeTaxes", "IncomeTaxExpenseIFRS"),
    "debt_short_term_loans": ("ShortTermLoansPayable",),
    "debt_current_long_term_loans": ("CurrentPortionOfLongTermLoansPayable",),
    "debt_long_term_loans": ("LongTermLoansPayable",),
    "debt_current_bonds": ("CurrentPortionOfBonds",),
    "debt_bonds": ("BondsPayable",),
    "debt_lease_current": ("LeaseObligationsCL",),
    "debt_lease_noncurrent": ("LeaseObligationsNCL",),
    "treasury_stock_purchase_cash_flow": ("PurchaseOfTreasuryStockFinCF",),
}

# --- ownership reports: column -> element local names ------------------------
OWNERSHIP_DOCUMENT_ELEMENTS = {
    "document_title": ("DocumentTitleCoverPage",),
    "clause_of_stipulation": ("ClauseOfStipulationCoverPage",),
    "cover_name": ("NameCoverPage",),
    "filing_requirement_date": ("DateWhenFilingRequirementAroseCoverPage",),
    "filing_date": ("FilingDateCoverPage",),
    "total_filers_joint_holders": ("TotalNumberOfFilersAndJointHoldersCoverPage",),
    "arrangement_of_filing": ("ArrangementOfFilingCoverPage",),
    "change_reason": ("ReasonForFilingChangeReportCoverPage",),
    "issuer_name": ("NameOfIssuer",),
    "issuer_security_code": ("SecurityCodeOfIssuer",),
    "stock_listing": ("StockListing", "ListedOrOTC"),
}
OWNERSHIP_HOLDER_ELEMENTS = {
    "holder_name": ("Name",),
    "purpose": ("PurposeOfHolding",),
    "important_proposal": ("ActOfMakingImportantProposalEtc",),
    "shares_held": ("TotalNumberOfStocksEtcHeld",),
    "potential_shares": ("NumberOfResidualStocksHeld",),
    "holding_ratio": ("HoldingRatioOfShareCertificatesEtc",),
    "previous_holding_ratio": ("HoldingRatioOfShareCertificatesEtcPerLastReport",),
}

# --- metric roles of the ratio builder ---------------------------------------
DEBT_COMPONENTS = (
    "debt_short_term_loans",
    "debt_current_long_term_loans",
    "debt_long_term_loans",
    "debt_current_bonds",
    "debt_bonds",
    "debt_lease_current",
    "debt_lease_noncurrent",
)
BALANCE_METRICS = (
    "shareholders_equity", "net_assets", "interest_bearing_debt", "cash_and_deposits", *DEBT_COMPONENTS,
)
FLOW_METRICS = (
    "net_income", "operating_income", "operating_cash_flow", "capital_expenditure",
    "pretax_income", "income_tax", "treasury_stock_purchase_cash_flow",
)
RATIO_METRICS = (
    "net_income", "operating_income", "shareholders_equity", "net_assets", "interest_bearing_debt",
    "cash_and_deposits", "operating_cash_flow", "capital_expenditure", "pretax_income", "income_tax",
    "treasury_stock_purchase_cash_flow", *DEBT_COMPONENTS,
)

# --- forecast column -> revision feature -------------------------------------
FORECAST_FEATURES = {
    "FSales": "forecast_sales_revision_pct",
    "FOP": "forecast_operating_profit_revision_pct",
    "FOdP": "forecast_ordinary_profit_revision_pct",
    "FNP": "forecast_net_profit_revision_pct",
    "FEPS": "forecast_eps_revision_pct",
}
BREADTH_FEATURE = "forecast_revision_breadth"

# --- feature name, higher is better, source dataset --------------------------
# Feature, whether higher is better, source datasets, description.
FEATURE_CATALOG = (
    ("momentum_12_1", True, ("daily_bars",), "Adjusted return from 252 to 21 trading days back; the last month is left out"),
    ("amihud_20d", False, ("daily_bars",), "Mean of absolute daily return per traded value over 20 trading days; high means illiquid"),
    ("avg_trading_value_20d", True, ("daily_bars",), "Mean traded value over 20 trading days"),
    ("roe", True, ("financial_metrics",), "Net income over equity at period end, or over net assets where equity is missing"),
    ("roic", True, ("financial_metrics",), "Operating income after the reported tax rate over equity plus debt less cash"),
    ("roic_pre_tax_proxy", True, ("financial_metrics",), "Operating income before tax over equity plus debt less cash"),
    ("fcf_conversion", True, ("financial_metrics",), "Operating cash flow less absolute capital expenditure, over net income"),
    ("buyback_cash_outflow", True, ("financial_metrics",), "Absolute cash spent on own shares"),
    ("buyback_to_equity", True, ("financial_metrics",), "Cash spent on own shares over positive equity"),
    ("net_debt", False, ("financial_metrics",), "Reported interest-bearing debt less cash"),
    ("interest_bearing_debt_components_proxy", False, ("financial_metrics",), "Sum of the reported loans, bonds and leases; no reported total"),
    ("net_debt_components_proxy", False, ("financial_metrics",), "Sum of the reported debt components less cash"),
    ("forecast_sales_revision_pct", True, ("financial_summary",), "Change of the sales forecast for one fiscal year over the absolute forecast before"),
    ("forecast_operating_profit_revision_pct", True, ("financial_summary",), "Change of the operating-profit forecast for one fiscal year over the absolute forecast before"),
    ("forecast_ordinary_profit_revision_pct", True, ("financial_summary",), "Change of the ordinary-profit forecast for one fiscal year over the absolute forecast before"),
    ("forecast_net_profit_revision_pct", True, ("financial_summary",), "Change of the net-profit forecast for one fiscal year over the absolute forecast before"),
    ("forecast_eps_revision_pct", True, ("financial_summary",), "Change of the forecast of earnings per share for one fiscal year over the absolute forecast before"),
    ("forecast_revision_breadth", True, ("financial_summary",), "Mean sign of the changes of all forecasts that can be compared, from -1 to 1"),
    ("ownership_ratio_change", True, ("ownership_summary",), "Change of the holding ratio of the holder with the largest absolute change in a document"),
)

# --- alias discovery: target -> keywords -------------------------------------
DISCOVERY_HINTS = {
    "interest_bearing_debt": (
        "debt", "borrow", "loan", "bond", "lease", "interestbearing", "有利子", "借入", "社債", "リース",
    ),
    "capital_expenditure": (
        "purchase", "acquisition", "propertyplant", "equipment", "intangible",
        "capitalexpenditure", "設備投資", "有形固定資産", "無形固定資産", "取得",
    ),
    "depreciation": ("depreciation", "amortization", "depreciationandamortization", "減価償却", "償却"),
    "eps": ("earningspershare", "incomeper share", "eps", "１株", "1株", "一株", "基本的１株"),
    "dividend_per_share": ("dividend", "dividendpershare", "配当", "１株当たり配当", "1株当たり配当"),
    "income_tax": ("incometax", "taxexpense", "corporatetax", "法人税", "所得税", "税金費用"),
    "investing_cash_flow": (
        "netcashprovidedbyusedininvest", "investmentactivities", "investingactivities",
        "投資活動によるキャッシュ・フロー",
    ),
    "management_forecast_revision": (
        "forecast", "forecasts", "forecasted", "guidance", "outlook", "revision", "revised",
        "businessresultsforecast", "業績予想", "予想", "見通し", "修正",
    ),
    "capital_allocation_buyback": (
        "treasurystock", "treasuryshares", "repurchase", "buyback", "purchaseoftreasury",
        "acquisitionoftreasury", "自己株式", "自社株", "取得自己株式",
    ),
}

# --- columns of normalised tables ---------------------------------------------
STATEMENT_TEXTS = (
    "doc_type_code", "doc_description", "parent_doc_id", "edinet_code", "sec_code", "stock_code",
    "filer_name", "period_start", "period_end", "submit_datetime", "known_at", "observed_at",
)
FACT_TEXTS = (
    "element_id", "item_name", "context_id", "relative_year", "consolidation", "period_type", "unit_id", "unit",
)
METRIC_COLUMNS = (
    "source_id", "dataset", "doc_id", *STATEMENT_TEXTS, "metric", "element_id", "local_name", "item_name",
    "context_id", "relative_year", "consolidation", "period_type", "unit_id", "unit", "raw_value",
    "numeric_value", "source_parquet_key", "ingestion_run_id",
)

REPORT_TEXTS = {
    "doc_type_code": "doc_type_code",
    "doc_description": "doc_description",
    "parent_doc_id": "parent_doc_id",
    "submit_datetime": "submit_datetime",
    "known_at": "known_at",
    "observed_at": "observed_at",
    "edinet_code": "filer_edinet_code",
    "filer_name": "filer_name",
    "issuer_edinet_code": "issuer_edinet_code",
    "subject_edinet_code": "subject_edinet_code",
}
SUBSTANTIAL_FIELDS = ("purpose", "shares_held", "potential_shares", "holding_ratio", "previous_holding_ratio")
PARSED_FIELDS = ("shares_held", "potential_shares", "holding_ratio", "previous_holding_ratio")
OWNERSHIP_COLUMNS = (
    "source_id", "dataset", "doc_id", "doc_type_code", "doc_description", "document_title",
    "is_change_report", "is_correction", "parent_doc_id", "submit_datetime", "known_at", "observed_at",
    "filer_edinet_code", "filer_name", "issuer_edinet_code", "subject_edinet_code", "issuer_name",
    "issuer_security_code", "issuer_stock_code", "stock_listing", "filing_requirement_date", "filing_date",
    "clause_of_stipulation", "change_reason", "arrangement_of_filing", "total_filers_joint_holders",
    "holder_context_id", "holder_name", "purpose", "important_proposal", "shares_held_raw", "shares_held",
    "potential_shares_raw", "potential_shares", "holding_ratio_raw", "holding_ratio",
    "previous_holding_ratio_raw", "previous_holding_ratio", "holding_ratio_change", "evidence_element_ids",
    "source_parquet_key", "ingestion_run_id",
)

# --- storage budget ----------------------------------------------------------
STORAGE_BUDGET_BYTES = 10 * 1024**3
STORAGE_LEVELS = (("critical", 0.95), ("warning", 0.85), ("watch", 0.70))
