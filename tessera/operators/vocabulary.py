"""Entity classes by document type: a base list that all types share, and the name of each type's own id field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Classes that entities of every document type may have.
BASE = [
    "Programme Name", "Project Name", "Portfolio", "Tier",
    "Supplier", "Government Departments", "Arm's Length Body", "Committee", "Organisational Unit", "Team", "Person", "Role", "Stakeholder", "Government Function",
    "Service", "Legislation", "Regulation", "Contract", "Framework", "Policy", "Standard", "Obligation", "Spending Control", "Assurance Review",
    "Commercial Model", "Procurement Route", "Lot", "SLA", "Penalty", "Critical Success Factor",
    "Cost Category", "Funding Source", "Financial Metric", "Accounting Standard", "Tax Regime", "Budget Line", "Headcount", "Outturn", "Contingency", "Write-off",
    "Thematic Topic of Digital", "Technological Application", "System", "Platform", "Data Asset", "API", "Integration", "Architecture Pattern", "Design Pattern", "Security Classification", "Accessibility Standard",
    "Methodology", "Benefit", "Risk", "Option", "Strategic Objective", "Outcome", "KPI", "Milestone", "Deliverable", "Dependency", "Capability", "Priority", "Manifesto Commitment", "Assumption", "Constraint",
    "Finding", "Recommendation", "Incident", "Lesson Learned", "User Need",
    "Document", "Process", "Approval Gate",
    "Location", "Sector", "Event",
]

#: Document types and their id fields.
ID_FIELDS = {
    "business_case": "Spend ID",
    "sr_bids_2025": "Bid Name",
    "sr_bids_2021": "Bid Name",
    "contract_finder": "Contract ID",
    "nao_report": "Report Name",
    "technology_report": "Report Name",
    "efficiency_report": "Department Name",
    "dbr_readout": "Readout Date",
    "dbr_report": "Department Name",
}
#: Types whose documents aren't cut by meaning.
PLAIN_CHUNKS = {"contract_finder"}


def classes(document_type: str) -> list[str]:
    """The classes of a type, its id field last; a type without an entry is an error."""
    if document_type not in ID_FIELDS:
        raise ValueError(f"no vocabulary for document type {document_type!r}")
    return [*BASE, ID_FIELDS[document_type]]


def outside(entities: DataFrame, document_type: str = "document_type", class_column: str = "class") -> DataFrame:
    """The rows whose class their type doesn't have; a null class or a type that is null or unknown has none."""
    own = F.create_map(*[F.lit(x) for pair in ID_FIELDS.items() for x in pair])
    known = F.col(document_type).isin(list(ID_FIELDS))
    allowed = known & (F.col(class_column).isin(BASE) | F.col(class_column).eqNullSafe(F.try_element_at(own, F.col(document_type))))
    return entities.where(~F.coalesce(allowed, F.lit(False)))
