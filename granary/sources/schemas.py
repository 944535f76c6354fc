"""Raw schemas of the six feeds. Business ids are BIGINT so that they do not run out."""

from __future__ import annotations

CRM_CUSTOMER = """
    cst_id BIGINT, cst_key STRING, cst_firstname STRING, cst_lastname STRING, cst_marital_status STRING,
    cst_gndr STRING, cst_create_date DATE
"""
CRM_PRODUCT = """
    prd_id BIGINT, prd_key STRING, prd_nm STRING, prd_cost INT, prd_line STRING, prd_start_dt DATE, prd_end_dt DATE
"""
CRM_SALES = """
    sls_ord_num STRING, sls_prd_key STRING, sls_cust_id BIGINT, sls_order_dt INT, sls_ship_dt INT, sls_due_dt INT,
    sls_sales INT, sls_quantity INT, sls_price INT
"""
ERP_CATEGORY = "ID STRING, CAT STRING, SUBCAT STRING, MAINTENANCE STRING"
ERP_CUSTOMER = "CID STRING, BDATE DATE, GEN STRING"
ERP_LOCATION = "CID STRING, CNTRY STRING"

FEEDS = {
    "crm_customer": CRM_CUSTOMER,
    "crm_product": CRM_PRODUCT,
    "crm_sales": CRM_SALES,
    "erp_category": ERP_CATEGORY,
    "erp_customer": ERP_CUSTOMER,
    "erp_location": ERP_LOCATION,
}
