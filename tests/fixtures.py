"""Six business documents as text, with the values they must give."""

TERMS = "Payment Terms: Net 30 days. Please pay by the date above. Late payments carry a fee."


def invoice(number, date, name, address, email, items, subtotal, tax, total):
    rows = [f"{desc} {qty} ${price:.2f} ${qty * price:.2f}" for desc, qty, price in items]
    return "\n".join([
        "INVOICE", f"Invoice Number: {number}", f"Invoice Date: {date}", f"Due Date: {date}",
        "Bill To:", name, address, f"Email: {email}", "Description Qty Unit Price Total", *rows,
        f"Subtotal: ${subtotal}", f"Tax (17%): ${tax}", f"Total Amount Due: ${total}", TERMS,
    ])


def report(period, region, total, lines):
    rows = [f"{name} {units} ${revenue} {share}%" for name, units, revenue, share in lines]
    return "\n".join([
        "QUARTERLY SALES REPORT", f"Reporting Period: {period}", f"Region: {region}",
        "Report Generated: 2025-10-05", "Executive Summary",
        f"Sales in {region} are listed below. Total revenue came to ${total}, with strong "
        "year-over-year growth. The performance of every line is shown in the table.",
        "Revenue Breakdown by Product Line", "Product Line Units Sold Revenue % of Total", *rows,
        f"TOTAL ${total} 100.0%", "Key Observations",
        "The team had a good quarter. Recommendations are to hire more people. The forecast is bright.",
    ])


def application(app_id, date, account, name, dob, ssn, email, phone, address, employer, title, income, years):
    return "\n".join([
        "CUSTOMER APPLICATION FORM", f"Application ID: {app_id}", f"Date of Application: {date}",
        f"Account Type Requested: {account}", "Personal Information", f"Full Name: {name}",
        f"Date of Birth: {dob}", f"National ID / SSN: {ssn}", f"Email Address: {email}",
        f"Phone Number: {phone}", f"Residential Address: {address}", "Employment Information",
        f"Employer: {employer}", f"Job Title: {title}", f"Annual Income: {income}",
        f"Years Employed: {years}",
        "I certify that all of this is true. I authorize a check of these statements.",
        f"Signature: {name}", f"Date: {date}",
    ])


# Names, numbers and dates of the six acceptance documents, and what is read from them.
TEXTS = {
    "invoice_001": invoice(
        "INV-2025-0042", "2025-09-15", "Acme Corporation", "123 Business Park, Karachi, Pakistan",
        "billing@acme-corp.com",
        [("Cloud Hosting (Monthly)", 1, 450), ("Premium Support Plan", 1, 200), ("Data Backup Storage (TB)", 3, 75)],
        "875.00", "148.75", "1023.75"),
    "invoice_002": invoice(
        "INV-2025-0089", "2025-10-02", "Globex Industries", "456 Industrial Road, Lahore, Pakistan",
        "accounts@globex.io",
        [("Software License Annual", 5, 1200), ("Onboarding Services", 1, 800)],
        "6800.00", "1156.00", "7956.00"),
    "sales_report_q3_2025": report(
        "Q3 2025 (July - September)", "South Asia", "482,350.00",
        [("Enterprise Software", 45, "215,000.00", 44.6), ("Cloud Services", 320, "156,800.00", 32.5),
         ("Professional Services", 22, "88,000.00", 18.2), ("Hardware Accessories", 410, "22,550.00", 4.7)]),
    "sales_report_q2_2025": report(
        "Q2 2025 (April - June)", "Middle East", "298,100.00",
        [("Enterprise Software", 28, "142,000.00", 47.6), ("Cloud Services", 215, "98,900.00", 33.2),
         ("Professional Services", 18, "57,200.00", 19.2)]),
    "customer_application_001": application(
        "APP-2025-77321", "2025-10-10", "Premium Savings Account", "Maaz Ahmed", "1998-05-12",
        "35202-1234567-8", "maaz.ahmed@example.com", "+92-300-1234567",
        "House 12, Street 4, Defence Phase II, Karachi", "R2V Private Limited", "Data Scientist", "$45,000", "2"),
    "customer_application_002": application(
        "APP-2025-77498", "2025-10-11", "Business Checking Account", "Sara Khan", "1995-11-23",
        "42101-9876543-2", "sara.khan@example.org", "+92-321-7654321", "Apartment 8B, Gulberg III, Lahore",
        "Tech Innovate Ltd", "Software Engineer", "$52,000", "3"),
}

METADATA = {
    "invoice_001": {
        "invoice_number": "INV-2025-0042", "invoice_date": "2025-09-15", "due_date": "2025-09-15",
        "bill_to": "Acme Corporation", "customer_email": "billing@acme-corp.com", "subtotal": 875.0,
        "tax": 148.75, "total_amount_due": 1023.75, "currency": "USD"},
    "invoice_002": {
        "invoice_number": "INV-2025-0089", "invoice_date": "2025-10-02", "due_date": "2025-10-02",
        "bill_to": "Globex Industries", "customer_email": "accounts@globex.io", "subtotal": 6800.0,
        "tax": 1156.0, "total_amount_due": 7956.0, "currency": "USD"},
    "sales_report_q3_2025": {
        "reporting_period": "Q3 2025 (July - September)", "quarter": "Q3 2025", "region": "South Asia",
        "report_generated": "2025-10-05", "total_revenue": 482350.0, "currency": "USD"},
    "sales_report_q2_2025": {
        "reporting_period": "Q2 2025 (April - June)", "quarter": "Q2 2025", "region": "Middle East",
        "report_generated": "2025-10-05", "total_revenue": 298100.0, "currency": "USD"},
    "customer_application_001": {
        "application_id": "APP-2025-77321", "application_date": "2025-10-10",
        "account_type": "Premium Savings Account", "applicant_name": "Maaz Ahmed",
        "date_of_birth": "1998-05-12", "national_id": "35202-1234567-8", "email": "maaz.ahmed@example.com",
        "phone": "+92-300-1234567", "employer": "R2V Private Limited", "job_title": "Data Scientist",
        "annual_income": "$45,000"},
    "customer_application_002": {
        "application_id": "APP-2025-77498", "application_date": "2025-10-11",
        "account_type": "Business Checking Account", "applicant_name": "Sara Khan",
        "date_of_birth": "1995-11-23", "national_id": "42101-9876543-2", "email": "sara.khan@example.org",
        "phone": "+92-321-7654321", "employer": "Tech Innovate Ltd", "job_title": "Software Engineer",
        "annual_income": "$52,000"},
}

KEYWORDS = {
    "invoice_001": {
        "invoice_number": "INV-2025-0042", "invoice_date": "2025-09-15", "due_date": "2025-09-15",
        "subtotal": 875.0, "tax": 148.75, "total_amount_due": 1023.75,
        "customer_name": "Acme Corporation", "email": "billing@acme-corp.com"},
    "invoice_002": {
        "invoice_number": "INV-2025-0089", "invoice_date": "2025-10-02", "due_date": "2025-10-02",
        "subtotal": 6800.0, "tax": 1156.0, "total_amount_due": 7956.0,
        "customer_name": "Globex Industries", "email": "accounts@globex.io"},
    "sales_report_q3_2025": {"reporting_period": "Q3 2025 (July - September)", "region": "South Asia"},
    "sales_report_q2_2025": {"reporting_period": "Q2 2025 (April - June)", "region": "Middle East"},
    "customer_application_001": {
        "email": "maaz.ahmed@example.com", "phone": "+92-300-1234567",
        "address": "House 12, Street 4, Defence Phase II, Karachi", "application_id": "APP-2025-77321",
        "applicant_name": "Maaz Ahmed", "date_of_birth": "1998-05-12",
        "account_type": "Premium Savings Account", "employer": "R2V Private Limited", "annual_income": 45000.0},
    "customer_application_002": {
        "email": "sara.khan@example.org", "phone": "+92-321-7654321",
        "address": "Apartment 8B, Gulberg III, Lahore", "application_id": "APP-2025-77498",
        "applicant_name": "Sara Khan", "date_of_birth": "1995-11-23",
        "account_type": "Business Checking Account", "employer": "Tech Innovate Ltd", "annual_income": 52000.0},
}

CATEGORY = {
    name: {"i": "Invoice", "s": "Sales Report", "c": "Customer Application"}[name[0]] for name in TEXTS
}
