"""The labels and messages the procedure writes, in stage order.

They must equal the procedure's text exactly (reports and tests compare them).
"""

# Fixed values — stage 1: customer tier
VIP = "VIP"
PREMIUM = "Premium"
STANDARD = "Standard"

# Fixed values — stage 2: customer value status
HIGH_VALUE = "High Value"
ABOVE_AVERAGE = "Above Average"

# Fixed values — stage 5: sales performance status
TOP_PERFORMER = "Top Performer"

# Fixed values — stage 7: validation types and messages
AMOUNT_VALIDATION = "Amount Validation"
AMOUNT_NOT_POSITIVE = "Amount must be greater than zero"
AMOUNT_TOO_HIGH = "Amount exceeds maximum allowed value"
VALID = "Valid"
CUSTOMER_VALIDATION = "Customer Status Validation"
CUSTOMER_INACTIVE = "Customer is not active"
CREDIT_EXCEEDED = "Customer credit limit exceeded"

# Fixed values — stage 8: final status; stage 4: queue status
VALIDATION_FAILED = "Validation Failed"
INVALID_AMOUNT = "Invalid Amount"
PROCESSED = "Processed"

# Fixed values — stage 9: execution log
PROCESS_NAME = "ComplexBusinessProcess"
SUCCESS = "Success"
PARTIAL_SUCCESS = "Partial Success"
FAILED = "Failed"

# Fixed values — stage 10: debug result sets
PROCESSING_SUMMARY = "Processing Summary"
DEPARTMENT_SUMMARY = "Department Summary"
VALIDATION_RESULTS = "Validation Results"

# Fixed values — stage 11: reclassification and customer segments
HIGH_FREQUENCY = "High Frequency"
ABOVE_REGIONAL_AVERAGE = "Above Regional Average"
PLATINUM = "Platinum"
GOLD = "Gold"
SILVER = "Silver"
BRONZE = "Bronze"

# Fixed values — stage 12: department target status
EXCEEDING_TARGET = "Exceeding Target"
MEETING_TARGET = "Meeting Target"
NEAR_TARGET = "Near Target"
BELOW_TARGET = "Below Target"

# Fixed values — stage 14: statistics status
WARNING = "Warning"
ERROR = "Error"

# Fixed values — separators: hierarchy path, distinct lists, error messages
PATH_SEPARATOR = " > "
LIST_SEPARATOR = ", "
MESSAGE_SEPARATOR = "; "
