"""Dimensions: metrics with their aliases and ranges, banking and proportion rules, institutions, settings."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession

from marlstone.sources.tables import inline

#: Fixed values, in template order: key, header, group, unit, institution types (bank, sfb, nbfc, hfc, aifi), tier, least and largest sane value, may be negative.
METRICS = [
    ('total_assets', 'Total Assets', 'Headline Size', 'currency', 'bsnha', 'A', 100.0, 90000000.0, False),
    ('total_deposits', 'Total Deposits', 'Headline Size', 'currency', 'bs', 'A', 10.0, 60000000.0, False),
    ('gross_advances', 'Total Advances (Gross)', 'Headline Size', 'currency', 'bsnha', 'A', 10.0, 60000000.0, False),
    ('aum', 'Assets Under Management (AUM)', 'Headline Size', 'currency', 'nha', 'B', 1.0, 30000000.0, False),
    ('market_cap', 'Market Capitalization', 'Headline Size', 'currency', 'bsnh', 'C', 1.0, 3000000.0, False),
    ('branches', 'Total Branches', 'Headline Size', 'count', 'bsnha', 'B', 1.0, 30000.0, False),
    ('employees', 'Total Employee Count', 'Headline Size', 'count', 'bsnha', 'B', 10.0, 400000.0, False),
    ('customers', 'Total Customer Base (Numbers)', 'Headline Size', 'count', 'bsnha', 'C', 10000.0, 1000000000.0, False),
    ('interest_earned', 'Interest Earned', 'Profit & Loss', 'currency', 'bsnha', 'A', 1.0, 5000000.0, False),
    ('interest_expended', 'Interest Expended', 'Profit & Loss', 'currency', 'bsnha', 'A', 1.0, 5000000.0, False),
    ('nii', 'Net Interest Income (NII)', 'Profit & Loss', 'currency', 'bsnha', 'A', -100000.0, 3000000.0, True),
    ('other_income', 'Other Income (Non-Interest)', 'Profit & Loss', 'currency', 'bsnha', 'B', -50000.0, 2000000.0, True),
    ('opex', 'Operating Expenses', 'Profit & Loss', 'currency', 'bsnha', 'B', 1.0, 2000000.0, False),
    ('employee_costs', 'Employee Costs', 'Profit & Loss', 'currency', 'bsnha', 'B', 0.1, 500000.0, False),
    ('total_provisions', 'Total Provisions', 'Profit & Loss', 'currency', 'bsnha', 'B', -100000.0, 1000000.0, True),
    ('pat', 'Profit After Tax (PAT)', 'Profit & Loss', 'currency', 'bsnha', 'A', -200000.0, 1000000.0, True),
    ('nim', 'Net Interest Margin (NIM) %', 'Profit & Loss', 'percent', 'bsnha', 'B', 0.0, 15.0, False),
    ('roa', 'Return on Assets (RoA) %', 'Profit & Loss', 'percent', 'bsnha', 'A', -5.0, 5.0, True),
    ('roe', 'Return on Equity (RoE) %', 'Profit & Loss', 'percent', 'bsnha', 'A', -50.0, 50.0, True),
    ('cost_to_income', 'Cost-to-Income Ratio %', 'Profit & Loss', 'percent', 'bsnha', 'B', 5.0, 95.0, False),
    ('gnpa_amount', 'Gross NPA (GNPA) Amount', 'Asset Quality', 'currency', 'bsnha', 'A', 0.0, 2000000.0, False),
    ('nnpa_amount', 'Net NPA (NNPA) Amount', 'Asset Quality', 'currency', 'bsnha', 'B', 0.0, 1500000.0, False),
    ('gnpa_ratio', 'Gross NPA Ratio %', 'Asset Quality', 'percent', 'bsnha', 'A', 0.0, 40.0, False),
    ('nnpa_ratio', 'Net NPA Ratio %', 'Asset Quality', 'percent', 'bsnha', 'B', 0.0, 25.0, False),
    ('pcr', 'Provision Coverage Ratio (PCR) %', 'Asset Quality', 'percent', 'bsnha', 'B', 0.0, 100.0, False),
    ('slippage_ratio', 'Slippage Ratio %', 'Asset Quality', 'percent', 'bsnha', 'C', 0.0, 20.0, False),
    ('write_offs', 'Write-offs During Year', 'Asset Quality', 'currency', 'bsnha', 'C', 0.0, 500000.0, False),
    ('stage3_pct', 'Stage 3 Assets % (NBFC)', 'Asset Quality', 'percent', 'nh', 'C', 0.0, 40.0, False),
    ('standard_assets_provision', 'Standard Assets Provision', 'Asset Quality', 'currency', 'bsnha', 'C', 0.0, 200000.0, False),
    ('credit_cost', 'Credit Cost %', 'Asset Quality', 'percent', 'bsnha', 'C', -2.0, 15.0, True),
    ('tier1', 'Tier 1 Capital Ratio %', 'Capital & Solvency', 'percent', 'bsnha', 'B', 0.0, 40.0, False),
    ('tier2', 'Tier 2 Capital Ratio %', 'Capital & Solvency', 'percent', 'bsnha', 'B', 0.0, 15.0, False),
    ('crar', 'Total CRAR (CAR) %', 'Capital & Solvency', 'percent', 'bsnha', 'A', 0.0, 40.0, False),
    ('cet1', 'Common Equity Tier 1 (CET1) %', 'Capital & Solvency', 'percent', 'bs', 'B', 0.0, 35.0, False),
    ('debt_to_equity', 'Debt-to-Equity Ratio', 'Capital & Solvency', 'ratio', 'bsnha', 'B', 0.0, 30.0, False),
    ('net_worth', 'Net Worth / Shareholders Equity', 'Capital & Solvency', 'currency', 'bsnha', 'A', 1.0, 5000000.0, False),
    ('pe_ratio', 'Price-to-Earnings (P/E) Ratio', 'Capital & Solvency', 'ratio', 'bsnh', 'C', 0.0, 150.0, False),
    ('pb_ratio', 'Price-to-Book (P/B) Ratio', 'Capital & Solvency', 'ratio', 'bsnh', 'C', 0.0, 20.0, False),
    ('dividend_yield', 'Dividend Yield %', 'Capital & Solvency', 'percent', 'bsnh', 'C', 0.0, 20.0, False),
    ('credit_rating', 'Credit Rating (Long Term)', 'Capital & Solvency', 'text', 'bsnha', 'C', None, None, False),
    ('casa_ratio', 'CASA Ratio %', 'Strategic & ESG', 'percent', 'bs', 'B', 0.0, 100.0, False),
    ('retail_mix', 'Retail Mix %', 'Strategic & ESG', 'percent', 'bsnha', 'C', 0.0, 100.0, False),
    ('wholesale_mix', 'Wholesale Mix %', 'Strategic & ESG', 'percent', 'bsnha', 'C', 0.0, 100.0, False),
    ('tech_spend_pct', 'Tech Spend (% of Opex)', 'Strategic & ESG', 'percent', 'bsnha', 'C', 0.0, 50.0, False),
    ('digital_txn_share', 'Digital Transaction Share %', 'Strategic & ESG', 'percent', 'bsnha', 'C', 0.0, 100.0, False),
    ('mobile_app_users', 'Mobile App Users (Active)', 'Strategic & ESG', 'count', 'bsnha', 'C', 100.0, 500000000.0, False),
    ('csr_spend', 'CSR Spending Amount', 'Strategic & ESG', 'currency', 'bsnha', 'C', 0.0, 10000.0, False),
    ('board_gender_diversity', 'Board Gender Diversity %', 'Strategic & ESG', 'percent', 'bsnha', 'C', 0.0, 100.0, False),
    ('psl_pct', 'Priority Sector Lending (PSL) %', 'Strategic & ESG', 'percent', 'bsa', 'C', 0.0, 100.0, False),
    ('esg_rating', 'ESG Rating (CRISIL/MSCI)', 'Strategic & ESG', 'text', 'bsnha', 'C', None, None, False),
    ('promoter_holding', 'Promoter Holding %', 'Strategic & ESG', 'percent', 'bsnha', 'C', 0.0, 100.0, False),
    ('tech_investment', 'Investment in Technology in last FY', 'Technology', 'currency', 'bsnha', 'C', 0.0, 50000.0, False),
]
#: Patterns of row labels per metric, tried in this order, case ignored.
ALIASES = {
    'total_assets': [r"Total\s+Assets", r"TOTAL\s+ASSETS", r"Total\s+of\s+Assets", r"Balance\s+Sheet\s+Size", r"Total\s+Assets\s*\(Rs\.?\s*in\s*crore\)"],
    'total_deposits': [r"Total\s+Deposits", r"^Deposits$", r"Deposits\s*\(Schedule\s*3\)", r"Customer\s+Deposits", r"Aggregate\s+Deposits"],
    'gross_advances': [r"Gross\s+Advances", r"Total\s+Advances", r"Gross\s+Loans?\s*(?:and\s+Advances)?", r"Advances\s*\(Gross\)", r"Gross\s+Loan\s+Book", r"Gross\s+Credit\s+Exposure", r"^Advances$"],
    'aum': [r"Assets?\s+Under\s+Management", r"\bAUM\b", r"Loan\s+Assets\s+Under\s+Management", r"Managed\s+Assets"],
    'market_cap': [r"Market\s+Capitali[sz]ation", r"Market\s+Cap\b", r"Mcap\b"],
    'branches': [r"Number\s+of\s+Branches", r"Total\s+Branches", r"Branch\s+Network", r"Branches\s*(?:as\s+(?:on|at))?", r"No\.?\s*of\s+Branches"],
    'employees': [r"Number\s+of\s+Employees", r"Total\s+Employees", r"Employee\s+Strength", r"Total\s+Headcount", r"No\.?\s*of\s+Employees", r"Permanent\s+Employees"],
    'customers': [r"Customer\s+Base", r"Total\s+Customers", r"Number\s+of\s+Customers", r"Customers\s+Served"],
    'interest_earned': [r"Interest\s+Earned", r"Interest\s+Income", r"Total\s+Interest\s+Income", r"Interest\s+earned\s*\(Schedule\s*13\)", r"Revenue\s+from\s+Operations\s*-\s*Interest"],
    'interest_expended': [r"Interest\s+Expended", r"Interest\s+Expense[sd]?", r"Finance\s+Cost[s]?", r"Interest\s+expended\s*\(Schedule\s*15\)", r"Total\s+Interest\s+Expense"],
    'nii': [r"Net\s+Interest\s+Income", r"\bNII\b", r"Interest\s+Income\s*\(net\)", r"Net\s+Interest\s+Earnings"],
    'other_income': [r"Other\s+Income", r"Non[-\s]?Interest\s+Income", r"Fee\s+and\s+Other\s+Income", r"Other\s+income\s*\(Schedule\s*14\)"],
    'opex': [r"Operating\s+Expenses", r"Total\s+Operating\s+Expenses", r"Operating\s+Costs?", r"Operating\s+expenses\s*\(Schedule\s*16\)", r"Non[-\s]?Interest\s+Expense"],
    'employee_costs': [r"Payments?\s+to\s+and\s+Provisions?\s+for\s+Employees", r"Employee\s+Costs?", r"Employee\s+Benefits?\s+Expenses?", r"Staff\s+Costs?", r"Personnel\s+Expenses"],
    'total_provisions': [r"Provisions?\s+and\s+Contingencies", r"Total\s+Provisions", r"Impairment\s+on\s+Financial\s+Instruments", r"Provisions?\s*\(other\s+than\s+tax\)", r"Expected\s+Credit\s+Loss"],
    'pat': [r"Profit\s+After\s+Tax", r"Net\s+Profit\s+for\s+the\s+(?:Year|Period)", r"Profit\s+for\s+the\s+(?:Year|Period)", r"\bPAT\b", r"Net\s+Profit"],
    'nim': [r"Net\s+Interest\s+Margin", r"\bNIM\b", r"Margin\s*\(NIM\)"],
    'roa': [r"Return\s+on\s+(?:Average\s+)?Assets", r"\bRoA\b", r"\bROA\b"],
    'roe': [r"Return\s+on\s+Equity", r"Return\s+on\s+Net\s+Worth", r"\bRoE\b", r"\bROE\b", r"Return\s+on\s+Shareholders?.?\s*Funds"],
    'cost_to_income': [r"Cost\s*(?:-|to|/)\s*Income\s*Ratio", r"Cost\s+to\s+Income", r"Efficiency\s+Ratio"],
    'gnpa_amount': [r"Gross\s+NPAs?\s*(?:Amount)?", r"Gross\s+Non[-\s]?Performing\s+Assets", r"\bGNPA\b", r"Gross\s+NPA\s*\(Amount\)"],
    'nnpa_amount': [r"Net\s+NPAs?\s*(?:Amount)?", r"Net\s+Non[-\s]?Performing\s+Assets", r"\bNNPA\b"],
    'gnpa_ratio': [r"Gross\s+NPA\s*(?:Ratio|%|\(%\))", r"%\s*of\s+Gross\s+NPAs?\s*to\s+Gross\s+Advances", r"GNPA\s*(?:Ratio|%)", r"Gross\s+NPA\s+to\s+Gross\s+Advances"],
    'nnpa_ratio': [r"Net\s+NPA\s*(?:Ratio|%|\(%\))", r"%\s*of\s+Net\s+NPAs?\s*to\s+Net\s+Advances", r"NNPA\s*(?:Ratio|%)"],
    'pcr': [r"Provision\s+Coverage\s+Ratio", r"\bPCR\b", r"Provisioning\s+Coverage\s+Ratio"],
    'slippage_ratio': [r"Slippage\s+Ratio", r"Gross\s+Slippage\s+Ratio", r"Fresh\s+Slippage\s+Ratio"],
    'write_offs': [r"Write[-\s]?offs?\s+during\s+the\s+year", r"Technical\s*/?\s*Prudential\s+Write[-\s]?offs?", r"Amounts?\s+Written\s+off", r"Bad\s+Debts\s+Written\s+Off"],
    'stage3_pct': [r"Stage\s*3\s*(?:Assets|Loans)?\s*(?:Ratio|%|\(%\))?", r"Gross\s+Stage\s*3", r"Stage\s*III\s*Assets"],
    'standard_assets_provision': [r"Provision\s+(?:for|on)\s+Standard\s+Assets", r"Standard\s+Assets?\s+Provision", r"General\s+Provision\s+on\s+Standard\s+Assets"],
    'credit_cost': [r"Credit\s+Cost", r"Cost\s+of\s+Credit", r"Credit\s+Cost\s+Ratio"],
    'tier1': [r"Tier\s*(?:1|I)\s*(?:Capital)?\s*(?:Ratio|Adequacy)?\s*(?:%|\(%\))?", r"Tier\s*1\s*CRAR"],
    'tier2': [r"Tier\s*(?:2|II)\s*(?:Capital)?\s*(?:Ratio|Adequacy)?\s*(?:%|\(%\))?", r"Tier\s*2\s*CRAR"],
    'crar': [r"\bCRAR\b", r"Capital\s+Adequacy\s+Ratio", r"Total\s+Capital\s+Ratio", r"\bCAR\b", r"Capital\s+to\s+Risk[-\s]?weighted\s+Assets\s+Ratio"],
    'cet1': [r"Common\s+Equity\s+Tier\s*(?:1|I)", r"\bCET\s*-?\s*1\b", r"CET1\s+Ratio"],
    'debt_to_equity': [r"Debt\s*(?:-|to|/)\s*Equity\s*(?:Ratio)?", r"Debt\s+Equity\s+Ratio", r"\bD/E\b", r"Gearing\s+Ratio"],
    'net_worth': [r"Net\s+Worth", r"Shareholders?'?\s*(?:Equity|Funds)", r"Total\s+Equity", r"Capital\s+and\s+Reserves", r"Equity\s+and\s+Reserves"],
    'pe_ratio': [r"Price\s*(?:-|to|/)\s*Earnings\s*(?:Ratio)?", r"\bP\s*/\s*E\b", r"PE\s+Ratio"],
    'pb_ratio': [r"Price\s*(?:-|to|/)\s*Book\s*(?:Value)?\s*(?:Ratio)?", r"\bP\s*/\s*B\b", r"PB\s+Ratio"],
    'dividend_yield': [r"Dividend\s+Yield", r"Yield\s+on\s+Dividend"],
    'credit_rating': [r"Long[-\s]?Term\s+(?:Credit\s+)?Rating", r"Credit\s+Rating", r"(?:CRISIL|ICRA|CARE|India\s+Ratings|Brickwork)\s*(?:AAA|AA\+?|AA-?|A\+?)"],
    'casa_ratio': [r"CASA\s*(?:Ratio|%|\(%\))?", r"Current\s+and\s+Savings\s+Account\s*(?:Ratio)?", r"CASA\s+to\s+Total\s+Deposits"],
    'retail_mix': [r"Retail\s+Mix", r"Retail\s+(?:Loans?|Advances|Book)\s*(?:as\s*)?%", r"Share\s+of\s+Retail", r"Retail\s+Proportion"],
    'wholesale_mix': [r"Wholesale\s+Mix", r"Wholesale\s+(?:Loans?|Advances|Book)\s*(?:as\s*)?%", r"Corporate\s+Mix", r"Share\s+of\s+Wholesale"],
    'tech_spend_pct': [r"Technology\s+Spend\s*(?:as\s*)?(?:%|percentage)\s*of\s*(?:Opex|Operating\s+Expenses)", r"IT\s+Spend\s*(?:as\s*)?%", r"Tech(?:nology)?\s+Spend\s*\(%\s*of\s*Opex\)"],
    'digital_txn_share': [r"Digital\s+Transactions?\s*(?:Share|Mix|%)", r"Share\s+of\s+Digital\s+Transactions?", r"(?:%|Percentage)\s*of\s+Transactions?\s+(?:done\s+)?Digitally"],
    'mobile_app_users': [r"(?:Active\s+)?Mobile\s+(?:Banking\s+)?(?:App\s+)?Users", r"Mobile\s+App\s+Users", r"Monthly\s+Active\s+Users", r"\bMAU\b"],
    'csr_spend': [r"CSR\s+(?:Spend(?:ing)?|Expenditure|Amount\s+Spent)", r"Corporate\s+Social\s+Responsibility\s+(?:Spend|Expenditure)", r"Amount\s+spent\s+(?:on|during\s+the\s+year)\s+(?:on\s+)?CSR"],
    'board_gender_diversity': [r"Board\s+Gender\s+Diversity", r"(?:%|Percentage)\s*of\s+Women\s+(?:Directors|on\s+the\s+Board)", r"Women\s+Directors?\s*(?:%|\(%\))", r"Gender\s+Diversity\s+(?:on\s+the\s+)?Board"],
    'psl_pct': [r"Priority\s+Sector\s+Lending\s*(?:%|Ratio)?", r"\bPSL\b\s*(?:%|Ratio)?", r"Priority\s+Sector\s+Advances\s*(?:as\s*)?(?:%|percentage)"],
    'esg_rating': [r"ESG\s+Rating", r"ESG\s+Score", r"(?:MSCI|CRISIL|Sustainalytics)\s+ESG\s+(?:Rating|Score)"],
    'promoter_holding': [r"Promoter\s+(?:and\s+Promoter\s+Group\s+)?(?:Share)?holding", r"Promoters?\s+Stake", r"Shareholding\s+of\s+Promoters?"],
    'tech_investment': [r"Investment\s+in\s+Technology", r"Technology\s+(?:Investment|Spend(?:ing)?|Expenditure)", r"IT\s+(?:Investment|Capex|Spend)", r"Digital\s+and\s+Technology\s+Investment"],
}
#: Canonical name, category, type, short names.
INSTITUTIONS = [
    ('State Bank of India (SBI)', 'D-SIB', 'bank', 'State Bank of India|SBI|State Bank|SBI Bank'),
    ('HDFC Bank Limited', 'D-SIB', 'bank', 'HDFC Bank|HDFC Bank Ltd|HDFCBANK'),
    ('ICICI Bank Limited', 'D-SIB', 'bank', 'ICICI Bank|ICICI Bank Ltd|ICICI|ICICIBANK'),
    ('Axis Bank Limited', 'Private Sector Bank', 'bank', 'Axis Bank|Axis Bank Ltd|UTI Bank'),
    ('Kotak Mahindra Bank Limited', 'Private Sector Bank', 'bank', 'Kotak Mahindra Bank|Kotak Bank|Kotak Mahindra Bank Ltd'),
    ('IndusInd Bank Limited', 'Private Sector Bank', 'bank', 'IndusInd Bank|IndusInd Bank Ltd|Indusind'),
    ('Yes Bank Limited', 'Private Sector Bank', 'bank', 'Yes Bank|YES BANK|Yes Bank Ltd'),
    ('IDFC First Bank Limited', 'Private Sector Bank', 'bank', 'IDFC FIRST Bank|IDFC First Bank Ltd|IDFC Bank'),
    ('Federal Bank Limited', 'Private Sector Bank', 'bank', 'Federal Bank|The Federal Bank Limited|The Federal Bank Ltd'),
    ('Bank of Baroda', 'Public Sector Bank', 'bank', 'BoB|BOB|Baroda Bank'),
    ('Punjab National Bank', 'Public Sector Bank', 'bank', 'PNB'),
    ('Canara Bank', 'Public Sector Bank', 'bank', 'Canara'),
    ('Union Bank of India', 'Public Sector Bank', 'bank', 'Union Bank'),
    ('Bank of India', 'Public Sector Bank', 'bank', 'BoI'),
    ('Indian Bank', 'Public Sector Bank', 'bank', ''),
    ('Central Bank of India', 'Public Sector Bank', 'bank', ''),
    ('AU Small Finance Bank Limited', 'Small Finance Bank', 'sfb', 'AU Small Finance Bank|AU Bank|AU SFB'),
    ('Equitas Small Finance Bank Limited', 'Small Finance Bank', 'sfb', 'Equitas Small Finance Bank|Equitas SFB'),
    ('Ujjivan Small Finance Bank Limited', 'Small Finance Bank', 'sfb', 'Ujjivan Small Finance Bank|Ujjivan SFB'),
    ('Bajaj Finance Limited', 'NBFC', 'nbfc', 'Bajaj Finance|Bajaj Finance Ltd|BFL'),
    ('Shriram Finance Limited', 'NBFC', 'nbfc', 'Shriram Finance|Shriram Transport Finance|STFC|Shriram Transport Finance Company'),
    ('Cholamandalam Investment and Finance Company Limited', 'NBFC', 'nbfc', 'Cholamandalam Investment and Finance|Chola|Cholamandalam|CIFCL'),
    ('Muthoot Finance Limited', 'NBFC', 'nbfc', 'Muthoot Finance|Muthoot'),
    ('L&T Finance Holdings Limited', 'NBFC', 'nbfc', 'L&T Finance|LTFH|L and T Finance Holdings|L&T Finance Holdings'),
    ('Mahindra & Mahindra Financial Services Limited', 'NBFC', 'nbfc', 'Mahindra Finance|M&M Financial Services|Mahindra and Mahindra Financial Services|MMFSL'),
    ('Tata Capital Limited', 'NBFC', 'nbfc', 'Tata Capital|Tata Capital Financial Services|TCL'),
    ('LIC Housing Finance Limited', 'Housing Finance Company', 'hfc', 'LIC Housing Finance|LICHFL|LIC HFL'),
    ('PNB Housing Finance Limited', 'Housing Finance Company', 'hfc', 'PNB Housing Finance|PNB Housing'),
    ('Can Fin Homes Limited', 'Housing Finance Company', 'hfc', 'Can Fin Homes|CanFin Homes'),
    ('NABARD', 'All-India Financial Institution', 'aifi', 'National Bank for Agriculture and Rural Development'),
    ('SIDBI', 'All-India Financial Institution', 'aifi', 'Small Industries Development Bank of India'),
    ('EXIM Bank', 'All-India Financial Institution', 'aifi', 'Export-Import Bank of India|Exim Bank of India'),
    ('NHB', 'All-India Financial Institution', 'aifi', 'National Housing Bank'),
    ('REC Limited', 'All-India Financial Institution', 'aifi', 'Rural Electrification Corporation|REC Ltd|REC'),
    ('Power Finance Corporation Limited', 'All-India Financial Institution', 'aifi', 'Power Finance Corporation|PFC|Power Finance Corporation Ltd'),
    ('IRFC', 'All-India Financial Institution', 'aifi', 'Indian Railway Finance Corporation'),
]
#: Logic rules (name, left metric, comparison, right metric or number).
RULES = [
    ("gnpa_gt_nnpa", "gnpa_amount", ">=", "nnpa_amount"), ("gnpa_ratio_gt_nnpa_ratio", "gnpa_ratio", ">=", "nnpa_ratio"), ("roe_gt_roa", "roe", ">=", "roa"), ("car_gt_cet1", "crar", ">=", "cet1"),
    ("car_gt_tier1", "crar", ">=", "tier1"), ("assets_gt_advances", "total_assets", ">", "gross_advances"), ("assets_gt_deposits", "total_assets", ">", "total_deposits"), ("pcr_under_100", "pcr", "<=", 100.0),
    ("tier_sum_is_crar", "tier1 + tier2", "~", "crar"), ("interest_earned_gt_expended", "interest_earned", ">", "interest_expended"), ("net_worth_positive", "net_worth", ">", 0.0),
]
#: Metric, anchor, least and largest ratio.
PROPORTIONS = [
    ("interest_earned", "total_assets", 0.01, 0.3), ("interest_expended", "interest_earned", 0.05, 0.95), ("nii", "interest_earned", 0.03, 0.95), ("other_income", "interest_earned", 0.001, 1.5),
    ("opex", "interest_earned", 0.02, 2.0), ("employee_costs", "opex", 0.05, 0.95), ("pat", "total_assets", -0.15, 0.15), ("total_deposits", "total_assets", 0.05, 0.95),
    ("gross_advances", "total_assets", 0.05, 0.95), ("net_worth", "total_assets", 0.01, 0.6), ("gnpa_amount", "gross_advances", 0.0, 0.4), ("nnpa_amount", "gnpa_amount", 0.0, 1.0), ("aum", "total_assets", 0.1, 5.0),
]
TYPES = {"b": "bank", "s": "sfb", "n": "nbfc", "h": "hfc", "a": "aifi"}


@dataclasses.dataclass(frozen=True)
class Profile:
    """Thresholds that the two rule profiles differ in."""

    write_floor: float = 65
    review_below: float = 80
    derive_floor: float = 80
    derived_cap: float = 90
    tolerance: float = 0.01
    tolerance_pp: float = 0.10


DOCUMENTED = Profile()
SHIPPED = Profile(write_floor=50, derive_floor=60)


def metrics(spark: SparkSession) -> DataFrame:
    """52 rows."""
    return inline(spark, "metric, header, band, unit, types, tier, low, high, negative", METRICS)


def aliases(spark: SparkSession) -> DataFrame:
    """(metric, ord, pattern)."""
    return inline(spark, "metric, ord, pattern", alias_rows())


def alias_rows() -> list[tuple]:
    return [(m, i, f"(?i){p}") for m, patterns in ALIASES.items() for i, p in enumerate(patterns)]


#: Registered numbers, and exchange symbols, of institutions.
CINS = {"State Bank of India (SBI)": "L65190MH1955PLC000018", "HDFC Bank Limited": "L65920MH1994PLC080618", "ICICI Bank Limited": "L65190GJ1994PLC021012", "Axis Bank Limited": "L65110GJ1993PLC020769", "Kotak Mahindra Bank Limited": "L65110MH1985PLC038137"}
TICKERS = {
    "State Bank of India (SBI)": "SBIN", "HDFC Bank Limited": "HDFCBANK", "ICICI Bank Limited": "ICICIBANK", "Axis Bank Limited": "AXISBANK", "Kotak Mahindra Bank Limited": "KOTAKBANK", "IndusInd Bank Limited": "INDUSINDBK", "Yes Bank Limited": "YESBANK",
    "IDFC First Bank Limited": "IDFCFIRSTB", "Federal Bank Limited": "FEDERALBNK", "Bank of Baroda": "BANKBARODA", "Punjab National Bank": "PNB", "Canara Bank": "CANBK", "Union Bank of India": "UNIONBANK", "Bank of India": "BANKINDIA", "Indian Bank": "INDIANB",
    "Central Bank of India": "CENTRALBK", "AU Small Finance Bank Limited": "AUBANK", "Equitas Small Finance Bank Limited": "EQUITASBNK", "Ujjivan Small Finance Bank Limited": "UJJIVANSFB", "Bajaj Finance Limited": "BAJFINANCE", "Shriram Finance Limited": "SHRIRAMFIN",
    "Cholamandalam Investment and Finance Company Limited": "CHOLAFIN", "Muthoot Finance Limited": "MUTHOOTFIN", "L&T Finance Holdings Limited": "LTF", "Mahindra & Mahindra Financial Services Limited": "M&MFIN", "LIC Housing Finance Limited": "LICHSGFIN",
    "PNB Housing Finance Limited": "PNBHOUSING", "Can Fin Homes Limited": "CANFINHOME", "REC Limited": "RECLTD", "Power Finance Corporation Limited": "PFC", "IRFC": "IRFC",
}


def institutions(spark: SparkSession) -> DataFrame:
    """(institution, category, type, short_names, cin, ticker): 36 rows."""
    return inline(spark, "institution, category, type, short_names, cin, ticker", [(*r, CINS.get(r[0], ""), TICKERS.get(r[0], "")) for r in INSTITUTIONS])
