"""Declared columns of the nominal record feed: 19 linked tables, five levels deep."""

from __future__ import annotations

from pyspark.sql import types as T

from arborload.functions.header import HEADER_FIELDS
from arborload.tree import Tree

ROOT = "nominal"
KEY = "PNCID"

# Columns of each table.  A column named like a table is the array
# that holds the rows of that table.
COLUMNS = {
    "nominal": [
        "PNCID", "CRONo", "PNCFilename", "Sex", "DateOfBirth", "EthnicAppearance",
        "Nationality1", "Nationality2", "Nationality3", "BRCStatus", "OffencesOnBailCount",
        "Occupation", "InformationMarker", "CaseHeader", "OperationalInformation",
    ],
    "caseheader": [
        "CaseType", "CautionType", "CourtCode", "ResultDate", "OffenderAddField1",
        "OffenderAddField2", "OffenderAddField3", "OffenderAddField4", "OffenderAddField5",
        "OffenderAddPcode", "OffenderAddFscode", "CourtName", "OtherTIC", "CourtCaseRef",
        "Offence", "Condition", "Method", "Custody", "BailConditions", "BreachOfBail",
    ],
    "occupation": ["OccupationCode", "OccupationDesc", "OccupationDate"],
    "informationmarker": ["IMCode", "IMLiteral", "IMDate", "IMFreeText", "IMFSRef"],
    "offence": [
        "OffenceACPO", "OffenceCCCJS", "OffenceQual1", "OffenceQual2", "OffenceStartDate",
        "OffenceEndDate", "OffenceAddF1", "OffenceAddF2", "OffenceAddF3", "OffenceAddF4",
        "OffenceAddF5", "OffenceAddPcode", "OffenceAddFree", "OffenceAddFscode",
        "ProcessStage", "StageProcessDate", "ForceBringingCharges", "CommittedOnBail",
        "Plea", "Adjudication", "OffenceText", "OffenceTIC", "ArrestSummonsRef",
        "CrimeOffenceRef", "OffenceStatusMarker", "CautionType", "Disposal",
        "SubsequentAppearance", "Cooffender",
    ],
    "disposal": [
        "DisposalType", "DisposalDuration", "DisposalAmount", "DisposalDate", "FineUnits",
        "DisposalQualifiers", "QualifierDuration", "DisposalText",
    ],
    "subsequentappearance": ["SAPReason", "SAPDate", "SAPCourtCode", "SAPCourtName"],
    "cooffender": ["PNCID", "Checkname"],
    "condition": ["ConditionText", "EndDate", "CompletionDate"],
    "method": ["CrimeOffenceRef", "MethodUsedInOffence", "MOKeywordLocation", "MOKeywordVictim"],
    "mokeywordlocation": ["MOKeyLocationCode", "MOKeyLocationDesc"],
    "mokeywordvictim": ["MOKeyVictimCode", "MOKeyVictimDesc"],
    "custody": ["CourtCaseRef", "ArrestSummonsRef", "CustodyDate", "PeriodInInstitution"],
    "periodininstitution": [
        "InstitutionPrisonCode", "InstitutionPrisonName", "PrisonCustodyFscode",
        "DateOfDetention", "EndOfDetentionDate", "PrisonerNumber", "ReleaseDetails",
    ],
    "releasedetails": [
        "ReleaseDate", "ReleaseReasonCode", "ReleaseReasonFullDesc", "SentenceExpiryDate",
        "ParoleRefNo", "LicenseParoleTypeCode", "LicenseParoleTypeDesc", "LicenseConditions",
        "SupervisionStartDate", "SupervisionEndDate",
    ],
    "bailconditions": ["ArrestSummonsRef", "RemandDate"],
    "breachofbail": [
        "ArrestSummonsRef", "RemandDate", "BailBreachDate", "BailBreachCondsDate",
        "BailBreachNature",
    ],
    "operationalinformation": [
        "OIReptClass", "OIReptType", "OIFSRef", "OICourtLocation", "ArrestSummonsRef",
        "OIReason", "OIStartDate", "OIEndDate", "OIText", "OINotifAddF1", "OINotifAddF2",
        "OINotifAddF3", "OINotifAddF4", "OINotifAddF5", "OINotifAddPcode", "OIConditions",
    ],
    "oiconditions": [
        "OICondition", "OICondAddF1", "OICondAddF2", "OICondAddF3", "OICondAddF4",
        "OICondAddF5", "OICondAddPcode",
    ],
}

HEADER = T.StructType(
    [T.StructField(f, T.BinaryType() if f == "recordHash" else T.StringType()) for f in HEADER_FIELDS.values()]
)


def table_schema(table: str) -> T.StructType:
    """Columns of one table with the rows of its child tables nested inside."""
    fields = []
    for column in COLUMNS[table]:
        child = column.lower()
        nested = child in COLUMNS and child != table
        fields.append(
            T.StructField(column, T.ArrayType(table_schema(child)) if nested else T.StringType())
        )
    return T.StructType(fields)


def document_schema() -> T.StructType:
    """Schema of a landed document: a header and a nested body."""
    return T.StructType([T.StructField("header", HEADER), T.StructField("body", table_schema(ROOT))])


def tree() -> Tree:
    """The 19 tables; links of the root and of case headers are counted with repeats."""
    return Tree.from_schema(ROOT, KEY, document_schema(), keep_repeats=["caseheader"])
