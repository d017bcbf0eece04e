"""The vocabulary of topic scans and reading bundles: fixed values, in their published order."""

from __future__ import annotations

#: Topic -> (label, query).
TOPICS = {
    "bank_competition": ("Bank competition and concentration", '(bank OR banks OR banking OR lender OR lenders OR mortgage OR mortgages OR deposit OR deposits) AND (competition OR concentration OR "market share" OR switching)'),
    "mortgage_arrears": ("Mortgage arrears and distressed debt", "mortgage AND (arrears OR restructuring OR repossession OR forbearance)"),
    "mortgage_switching": ("Mortgage switching and refinancing", "mortgage AND (switching OR refinance OR refinancing OR cashback)"),
    "sme_finance": ("SME finance and credit access", '(SME OR "small business" OR "small and medium enterprises") AND (credit OR lending OR finance OR funding)'),
    "credit_unions": ("Credit unions", '"credit union" OR "credit unions"'),
    "consumer_harm": ("Consumer harm and vulnerability", "(consumer OR customer) AND (harm OR vulnerable OR vulnerability OR detriment OR exploitation)"),
    "fraud_scams": (
        "Fraud, scams and payment deception",
        'fraud OR fraudulent OR scam OR scams OR phishing OR smishing OR vishing OR impersonation OR "money mule" OR "money mules" OR "authorised push payment" OR "authorized push payment"',
    ),
    "aml_cft": ("AML, CFT and financial crime controls", 'AML OR "money laundering" OR "terrorist financing" OR sanctions'),
    "reg_reporting": ("Regulatory reporting burden and quality", "(reporting OR returns OR submission) AND (burden OR manual OR error OR quality OR reconciliation OR duplication)"),
    "data_quality": ("Data quality and fragmentation", '"data quality" OR "data governance" OR "data gap" OR "fragmented data"'),
    "authorisation": ("Authorisation and licensing", 'authorisation OR authorization OR licensing OR "application process"'),
    "operational_resilience": ("Operational resilience and outsourcing", '"operational resilience" OR outsourcing OR "third party risk" OR "third-party risk" OR "critical third party" OR "business continuity" OR DORA'),
    "cybersecurity": ("Cybersecurity and ICT risk", 'cybersecurity OR cyber OR "ICT risk" OR ransomware'),
    "payments": ("Payments and electronic money", 'payments OR "electronic money" OR "e-money" OR "payment institution"'),
    "open_banking": ("Open banking and data portability", '"open banking" OR PSD2 OR AISP OR PISP OR "account information service" OR "payment initiation service" OR "data portability"'),
    "cash_access": ("Cash access and infrastructure", "cash AND (access OR ATM OR infrastructure OR acceptance OR withdrawal)"),
    "financial_inclusion": ("Financial inclusion and basic access", '"financial inclusion" OR "basic bank account" OR unbanked OR exclusion'),
    "insurance_protection_gap": ("Insurance affordability and protection gaps", 'insurance AND (affordability OR availability OR exclusion OR "protection gap")'),
    "climate_finance": ("Climate and financial risk", "climate AND (risk OR insurance OR lending OR finance OR transition OR physical)"),
    "funds_sector": ("Funds and asset management", 'UCITS OR AIF OR "investment fund" OR "fund management company"'),
    "financial_literacy": ("Financial literacy and consumer understanding", '"financial literacy" OR "financial education" OR "consumer understanding"'),
    "complaints_redress": ("Complaints and consumer redress", "complaints OR redress OR remediation OR compensation"),
    "legacy_systems": ("Legacy technology and manual processes", '"legacy system" OR "legacy systems" OR "manual process" OR spreadsheets'),
    "housing_credit": ("Housing, mortgages and credit supply", "housing AND (mortgage OR credit OR lending OR affordability OR supply)"),
}

#: Theme -> (label, query).
THEMES = {
    "compliance_cost": (
        "Cost and disproportionality",
        '"disproportionate" OR "disproportionately" OR "cost of compliance" OR "compliance burden" OR "administrative burden" OR "resource intensive" OR "resource-intensive" OR "significant cost"',
    ),
    "duplication": ("Duplicated effort and re-reporting", '"duplication" OR "duplicative" OR "already provided" OR "already reported" OR "same information" OR "multiple returns" OR "re-submit" OR "resubmit"'),
    "manual_effort": ("Manual work and spreadsheets", '"manual" OR "manually" OR "spreadsheet" OR "spreadsheets" OR "re-key" OR "rekey" OR "paper-based"'),
    "proportionality": ("Proportionality and smaller firms", '"proportionality" OR "proportionate" OR "smaller firms" OR "smaller entities" OR "small firms" OR "one size fits all" OR "one-size-fits-all"'),
    "implementation_time": ("Implementation timelines", '"implementation period" OR "lead time" OR "lead-in" OR "insufficient time" OR "not feasible" OR "transitional period" OR "sufficient time"'),
    "ambiguity": ("Unclear requirements", '"unclear" OR "ambiguous" OR "ambiguity" OR "further clarity" OR "additional clarity" OR "clarification is" OR "we would welcome clarity"'),
    "definitions": ("Definitions and inconsistency", '"definition" AND (unclear OR inconsistent OR differs OR differ OR aligned OR alignment)'),
    "systems_change": ("IT and system change", '"system changes" OR "systems changes" OR "IT systems" OR "legacy system" OR "legacy systems" OR "system build" OR "system development" OR "technology investment"'),
    "data_quality": ("Data quality and reconciliation", '"data quality" OR "data governance" OR "reconciliation" OR "reconcile" OR "data integrity"'),
    "reporting_burden": ("Regulatory reporting mechanics", '(reporting OR "returns" OR "return") AND (burden OR frequency OR template OR templates OR taxonomy OR XBRL)'),
    "outsourcing": ("Outsourcing and third parties", '"outsourcing" OR "outsourced" OR "third party" OR "third-party" OR "intragroup" OR "intra-group"'),
    "authorisation_delay": ("Authorisation and approval friction", '"authorisation process" OR "approval process" OR "application process" OR "delays" OR "timeframes"'),
    "fitness_probity": ("Individual approval and vetting", '"fitness and probity" OR "pre-approval" OR "PCF" OR "controlled function"'),
    "customer_comms": ("Customer disclosure mechanics", '"disclosure requirements" OR "customer communication" OR "information overload" OR "warning statement"'),
    "complaints_ops": ("Complaints handling operations", '"complaints handling" OR "complaint handling" OR "root cause" OR "root-cause" OR "complaints process"'),
    "fraud_ops": ("Fraud and scam handling", 'fraud OR scam OR scams OR "authorised push payment" OR "money mule" OR impersonation'),
    "safeguarding_ops": ("Safeguarding client money", '"safeguarding" OR "client money" OR "client assets" OR "segregation of funds" OR "safeguarded funds"'),
    "vulnerability": ("Vulnerable customers in practice", '"vulnerable customer" OR "vulnerable customers" OR "vulnerability" OR "in vulnerable circumstances"'),
    "switching_ops": ("Switching and portability mechanics", '"switching" OR "switch" OR "portability" OR "account transfer"'),
    "credit_union_ops": ("Credit union operating constraints", '"credit union" OR "credit unions" OR "common bond" OR "CUSO"'),
}

#: Reading bundle -> (question, queries).
BUNDLES = {
    "architecture": (
        "Who the actors are and how the system is wired",
        [
            '"our mandate" OR "statutory objectives" OR "functions of the Central Bank" OR "Commission of the Central Bank"',
            '"Single Supervisory Mechanism" OR "European Central Bank" OR "national competent authority" OR "European Banking Authority" OR "EIOPA" OR "ESMA"',
            '"Financial Services and Pensions Ombudsman" OR "Competition and Consumer Protection Commission" OR "Department of Finance" OR "An Garda" OR "Banking and Payments Federation"',
            '"memorandum of understanding" OR "cooperation agreement" OR "information sharing" AND authorities',
            '"deposit guarantee" OR "Investor Compensation" OR "Insurance Compensation Fund" OR "resolution authority"',
        ],
    ),
    "supervision": (
        "How supervision actually works, then and now",
        [
            '"PRISM" OR "impact category" OR "probability rating" OR "engagement model"',
            '"integrated supervision" OR "supervisory strategy" OR "supervisory approach" OR "multi-year"',
            '"gatekeeping" OR "authorisation process" OR "application for authorisation" OR "key facts document"',
            '"thematic inspection" OR "themed inspection" OR "review found" OR "we expect firms"',
            '"proportionate" AND (supervision OR supervisory)',
        ],
    ),
    "enforcement": (
        "Consequences: enforcement, accountability, redress",
        [
            '"administrative sanctions" OR "enforcement action" OR "settlement agreement" OR "monetary penalty"',
            '"Individual Accountability" OR "SEAR" OR "senior executive accountability" OR "conduct standards"',
            '"fitness and probity" OR "pre-approval controlled function" OR "PCF"',
            '"prohibition notice" OR "revocation" OR "direction issued"',
        ],
    ),
    "consumer_protection": (
        "The consumer rulebook and how it evolved",
        [
            '"Consumer Protection Code" OR "the Code" AND consumer',
            '"securing customers interests" OR "customers best interests" OR "consumer protection outcomes"',
            '"vulnerable" OR "vulnerability" AND (consumer OR customer)',
            '"complaints handling" OR "complaints process" OR "root cause" OR "错误" OR "errors and remediation"',
            '"informing effectively" OR "disclosure" OR "key information"',
        ],
    ),
    "banking_credit": (
        "Household and SME credit, arrears, switching",
        [
            '"household credit market" OR "mortgage measures" OR "loan to income" OR "loan to value"',
            '"arrears" OR "restructure" OR "forbearance" OR "repossession"',
            '"switching" OR "switcher" OR "refinance" OR "cashback"',
            '"SME" OR "small and medium" AND (credit OR lending OR rejection)',
            '"non-bank" OR "credit servicing" OR "loan sale" OR "portfolio sale"',
        ],
    ),
    "credit_unions": (
        "The mutual sector: reach, constraints, restructuring",
        [
            '"credit union" AND (restructuring OR consolidation OR amalgamation OR transfer)',
            '"loan to asset" OR "lending capacity" OR "business model" AND "credit union"',
            '"common bond" OR "shared services" OR "CUSO" OR "collaboration" AND "credit union"',
            '"credit union" AND (governance OR "risk management" OR skills OR resources)',
        ],
    ),
    "payments": (
        "Payments, e-money, fraud and the national plumbing",
        [
            '"payment institution" OR "electronic money" OR "e-money" OR "safeguarding"',
            '"PSD2" OR "payment services regulations" OR "strong customer authentication" OR "open banking"',
            'fraud OR scam OR "authorised push payment" OR "money mule" OR impersonation',
            '"National Payments Strategy" OR "retail payments" OR "cash access" OR "SEPA" OR "instant payments"',
        ],
    ),
    "funds_insurance": (
        "The export platform: funds, insurance, reinsurance",
        [
            '"UCITS" OR "AIF" OR "fund management company" OR "depositary" OR "administrator"',
            '"liquidity management" OR "leverage" OR "valuation" OR "delegation" AND fund',
            '"Solvency II" OR "own risk and solvency" OR "reserving" OR "underwriting"',
            '"differential pricing" OR "claims" OR "protection gap" AND insurance',
        ],
    ),
    "data_reporting": (
        "Regulatory reporting, data and the plumbing of compliance",
        [
            '"regulatory reporting" OR "returns" AND (accuracy OR quality OR timeliness OR resubmission)',
            '"taxonomy" OR "XBRL" OR "reporting template" OR "validation rules" OR "filing"',
            '"Central Credit Register" OR "credit reporting" OR "data collection"',
            '"data quality" OR "data governance" OR "aggregation" OR "lineage"',
        ],
    ),
    "resilience": (
        "Operational resilience, outsourcing, technology",
        [
            '"operational resilience" OR "business continuity" OR "critical or important"',
            '"outsourcing" OR "third party" OR "intragroup" OR "concentration risk" OR "exit plan"',
            '"DORA" OR "digital operational resilience" OR "ICT" OR "cyber" OR "incident reporting"',
            '"legacy" OR "technology" AND (investment OR debt OR modernisation)',
        ],
    ),
    "history": (
        "How the system got here",
        [
            '"financial crisis" OR "Honohan" OR "Nyberg" OR "Programme of Support" OR "troika"',
            '"tracker mortgage" OR "examination" AND redress',
            '"Financial Measures Programme" OR "PCAR" OR "PLAR" OR "recapitalisation"',
            '"lessons learned" OR "root causes" OR "we did not" OR "failure of supervision"',
        ],
    ),
}

#: The bundle that takes one voice alone.
INDUSTRY = (
    "industry_voice",
    "What firms themselves say is broken",
    [
        '"disproportionate" OR "administrative burden" OR "cost of compliance" OR "resource intensive"',
        '"unclear" OR "ambiguous" OR "further clarity" OR "we would welcome clarity"',
        '"duplication" OR "duplicative" OR "already reported" OR "already provided"',
        '"smaller firms" OR "proportionality" OR "one size fits all"',
        '"manual" OR "spreadsheet" OR "system changes" OR "IT systems" OR "lead time"',
        '"practical difficulties" OR "operational challenge" OR "in practice" AND difficult',
    ],
)
