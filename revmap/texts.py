"""Texts written into report columns."""

# Users match on these strings, so they stay exactly as they are.

# Raw mapping checks
QUICK_CHECK = "Quick Data Quality Check"
UNIQUENESS_CHECK = "Uniqueness Check"
COMPLETENESS_CHECK = "Completeness Check"
FORMAT_CHECK = "ID Format Check"
EMPTY_CHECK = "Empty String Check"
LENGTH_CHECK = "Data Length Check"
RAW_SUMMARY = "DATA QUALITY SUMMARY"
RAW_PREVIEW = "Sample Data Preview"
ID_PATTERN = "^[A-Za-z0-9]+$"

PASS = "PASS"
WARNING = "WARNING"
FAIL = "FAIL"
FAIL_QUICK = "FAIL - Check data quality"
FAIL_DUPLICATE_IDS = "FAIL - Duplicate IDs found"
FAIL_DUPLICATES = "FAIL - Duplicates found"
FAIL_NULL_IDS = "FAIL - NULL IDs found"
PASS_QUALITY = "PASS - Data quality acceptable"
FAIL_QUALITY = "FAIL - Data quality issues detected"
TOTAL_RECORDS = "Total Records"
UNIQUE_IDS = "Unique IDs"
NULL_IDS = "NULL IDs"

# Import gates
NO_ROWS = "Import validation failed: No rows loaded"
DUPLICATE_IDS = "WARNING: Duplicate IDs found in imported data"
NULL_IDS_FOUND = "WARNING: NULL IDs found in imported data"
STRICT_NO_ROWS = "Data quality check failed: No rows loaded"
STRICT_DUPLICATE_IDS = "Data quality check failed: Duplicate IDs found"

# Merged checks
COVERAGE_SUMMARY = "REVENUE COVERAGE SUMMARY"
UNMAPPED_REVENUE = "UNMAPPED REVENUE RECORDS"
UNMAPPED_REASON = "No matching mapping record found - mapping fields will be NULL in view"
UNUSED_MAPPING = "UNUSED MAPPING RECORDS"
UNUSED_REASON = "No matching revenue record found for prior month"
MERGED_COMPLETENESS = "DATA COMPLETENESS CHECK"
MERGED_DUPLICATES = "DUPLICATE CHECK"
REVENUE_BY_MAPPING = "REVENUE SUMMARY BY MAPPING"
UNMAPPED = "UNMAPPED"
UNMAPPED_SUMMARY = "UNMAPPED REVENUE SUMMARY"
MERGED_REPORT = "COMPREHENSIVE DATA QUALITY REPORT"
FAIL_DUPLICATE_REVENUE = "FAIL - Duplicate revenue IDs found"
WARN_COVERAGE = "WARNING - Low mapping coverage"
MERGED_PREVIEW = "SAMPLE MAPPED DATA"

# Exports
EXPORT_COMPLETED = "EXPORT COMPLETED"
EXPORT_VERIFICATION = "EXPORT VERIFICATION SUMMARY"
PASS_ALL_ROWS = "PASS - All rows exported"
WARN_ROWS = "WARNING - Row count mismatch"
EXPORT_QA = "EXPORT QA SUMMARY"
FAIL_NO_FILE = "FAIL - File not found"
FAIL_EMPTY_FILE = "FAIL - File is empty"
WARN_IDS = "WARNING - Unique ID count mismatch"
PASS_EXPORT = "PASS - Export validation successful"
DETAIL_NO_FILE = "File does not exist in S3 stage"
DETAIL_EMPTY_FILE = "Exported file contains no data"
DETAIL_OK = "All validations passed"
EXPORT_FAILED = "EXPORT VALIDATION FAILED"
REASON_NO_FILE = "File not found in S3"
REASON_ROWS = "Row count mismatch"
REASON_EMPTY = "Exported file is empty"
MISSING_IN_EXPORT = "MISSING IN EXPORT"
RECORD_EXISTS = "RECORD EXISTS CHECK"
EXPORTED_CHECK = "EXPORTED FILE CHECK"
SINGLE_RECORD_CHECK = "SINGLE RECORD EXPORT CHECK"

# Header checks
HEADERS_FOUND = "HEADERS FOUND - First row contains expected header values"
HEADERS_LIKELY = "HEADERS LIKELY PRESENT - First row contains text values (likely headers)"
HEADERS_NONE = "NO HEADERS - First row contains numeric data (likely data row)"
HEADERS_UNCERTAIN = "UNCERTAIN - First row format unclear"
FILE_STATISTICS = "FILE STATISTICS"
COUNT_PRESENT = "HEADERS PRESENT - File has 1 extra row (header row)"
COUNT_NONE = "NO HEADERS - File row count matches source (no header row)"
COUNT_MISMATCH = "ROW COUNT MISMATCH - Check manually"
HEADER_VALIDATION = "HEADER VALIDATION"
HEADERS_CONFIRMED = "✓ HEADERS CONFIRMED - First row matches expected header pattern"
HEADERS_NOT_FOUND = "✗ HEADERS NOT FOUND - First row does not match expected headers"
HEADER_ROW = "HEADER ROW (if headers exist)"
DATA_ROW = "DATA ROW"
