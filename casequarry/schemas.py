"""Explicit schemas and domains of the six export tables and the collection."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, FloatType, IntegerType, StringType, StructField,
                               StructType, TimestampType)


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Field names, required fields and domains of the export tables.
CASE_FIELDS = [
    "Id", "CaseNumber", "AccountId", "Status", "Priority", "Product__c", "Category__c",
    "CreatedDate", "ClosedDate", "Subject", "Description", "Resolution__c", "Error_Codes__c",
    "Issue_Plain_Text__c", "Cause_Plain_Text__c", "GSD_Environment_Plain_Text__c",
    "Resolution_Code__c", "Resolution_Plain_Text__c", "Product_Type__c", "Product_Line__c",
    "Root_Cause__c"]
TABLES: dict[str, StructType] = {
    "case": strings(*CASE_FIELDS),
    "task": strings("Type", "Description", "CaseId"),
    "workorder": strings("WorkOrderNumber", "Subject", "Description", "CaseId", "Id"),
    "casecomment": strings("CommentBody", "ParentId"),
    "workorderfeed": strings("Type", "Body", "ParentId"),
    "emailmessage": strings("Subject", "TextBody", "ParentId", "MessageDate"),
}
FILES = {"case": "cases.json", "task": "tasks.json", "workorder": "workorders.json",
         "casecomment": "casecomments.json", "workorderfeed": "workorderfeeds.json",
         "emailmessage": "emailmessages.json"}
REQUIRED = {
    "case": ["Id", "CaseNumber", "Subject", "Description", "Status"],
    "task": ["Type", "Description", "CaseId"],
    "workorder": ["WorkOrderNumber", "CaseId"],
    "casecomment": ["CommentBody", "ParentId"],
    "workorderfeed": ["Type", "Body", "ParentId"],
    "emailmessage": ["Subject", "TextBody", "ParentId"],
}
FOREIGN_KEY = {"task": "CaseId", "workorder": "CaseId", "casecomment": "ParentId",
               "workorderfeed": "ParentId", "emailmessage": "ParentId"}
PLURAL = {"task": "tasks", "workorder": "workorders", "casecomment": "comments",
          "workorderfeed": "feeds", "emailmessage": "emails"}
TASK_TYPES = ["Plan of Action", "Trouble Shooting"]
CASE_STATUS = ["New", "In Progress", "Pending", "Closed", "Cancelled"]
CASE_PRIORITY = ["Low", "Medium", "High", "Critical"]

# Export field -> name used by the composite text and the collection.
CASE_NAMES = {
    "Id": "caseId", "CaseNumber": "caseNumber", "AccountId": "accountId", "Status": "status",
    "Priority": "priority", "Product__c": "product", "Category__c": "category",
    "CreatedDate": "createdDate", "ClosedDate": "closedDate", "Subject": "subject",
    "Description": "description", "Resolution__c": "resolution", "Error_Codes__c": "error_codes",
    "Issue_Plain_Text__c": "issue_plain_text", "Cause_Plain_Text__c": "cause_plain_text",
    "GSD_Environment_Plain_Text__c": "environment", "Resolution_Code__c": "resolution_code",
    "Resolution_Plain_Text__c": "resolution_plain_text", "Product_Type__c": "product_type",
    "Product_Line__c": "product_line", "Root_Cause__c": "root_cause"}

COLLECTION = StructType(
    [StructField(n, StringType()) for n in (
        "caseId", "caseNumber", "accountId", "status", "priority", "product", "category")]
    + [StructField(n, TimestampType()) for n in ("createdDate", "closedDate")]
    + [StructField(n, StringType()) for n in (
        "subject", "description", "resolution", "errorCodes", "issuePlainText", "causePlainText",
        "environment", "resolutionCode", "resolutionPlainText", "productType", "productLine",
        "rootCause", "compositeText")]
    + [StructField(n, IntegerType()) for n in (
        "taskCount", "workOrderCount", "commentCount", "workOrderFeedCount", "emailCount")]
    + [StructField("processedDate", TimestampType()), StructField("pipelineVersion", StringType()),
       StructField("embeddingModel", StringType())])
VECTOR = StructField("vector", ArrayType(FloatType()))


def schema_differences(found: StructType, wanted: StructType) -> list[str]:
    """Missing, added and retyped columns."""
    have = {f.name: f.dataType.simpleString() for f in found.fields}
    want = {f.name: f.dataType.simpleString() for f in wanted.fields}
    return ([f"missing {n}" for n in want if n not in have]
            + [f"added {n}" for n in have if n not in want]
            + [f"{n}: {have[n]} is not {want[n]}" for n in want if n in have and have[n] != want[n]])
