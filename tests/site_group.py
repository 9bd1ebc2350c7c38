"""A small site group written as delivered files: two months, a few sites, every edge row.

All values are invented for the tests.
"""

import pathlib

FILES = {
    "pms_open_dental/procedures": """ClinicNum,AptNum,PatNum,ProcDate,ProvNum,ProcCode,ProcFee,WriteOff,AptStatus
1,100,7,2025-03-04,11,D1,120.00,20.00,2
1,100,7,2025-03-04,12,D2,80.00,0,2
1,101,8,2025-03-05,11,,0,0,5
1,102,9,2025-03-06,99,D1,120.00,0,9
77,103,9,2025-03-06,11,D1,55.00,0,2
""",
    "pms_open_dental/providers": """ProvNum,ClinicNum,IsSecondary
11,1,0
12,1,1
""",
    "pms_open_dental/payments": """ClinicNum,PayDate,PayType,PayAmt
1,2025-03-07,Insurance,150.25
1,2025-03-09,Patient,30
""",
    # the same provider id in two offices doubles its lines
    "pms_dentrix_ascend/procedures": """locationId,appointmentId,patientId,procedureDate,providerId,adaCode,fee,adjustmentTotal,appointmentStatus
asc-1,apt-1,pat-1,2025-03-10T00:00:00Z,prv-1,NEW,100,10,COMPLETE
asc-1,apt-2,pat-2,2025-03-11T00:00:00Z,prv-2,NEW,100,0,BROKEN
asc-1,apt-3,pat-3,2025-04-01T00:00:00Z,prv-9,ZZZ,40,0,CANCELLED
""",
    "pms_dentrix_ascend/providers": """providerId,locationId,providerType
prv-1,asc-1,HYGIENIST
prv-2,asc-1,DENTIST
prv-2,asc-2,DENTIST
""",
    "pms_dentrix_ascend/payments": """locationId,transactionDate,transactionType,amount
asc-1,2025-03-12T00:00:00Z,INSURANCE_PAYMENT,70
""",
    "pms_sensei/procedures": """Practice,Date of Service,Procedure,Charge,Adj,Provider,Appt Status,Patient #,Appointment #
P1,5-Mar-2025,D1,10,1,H,Completed,1,1
P1,05-Mar-2025,D2,20,2,D,No Show,2,2
P1,06-Mar-2025,,0,0,D,Canceled,3,3
""",
    "pms_sensei/providers": "Practice,Provider,Provider Type\nP1,H,Hygienist\nP1,D,Doctor\n",
    "pms_sensei/payments": "Practice,Date,Transaction Type,Amount\nP1,08-Mar-2025,Insurance Payment,5\nP1,8-Mar-2025,Other,6\n",
    "pms_dolphin/procedures": """office_code,visit_id,patient_ref,service_date,provider_code,ada_code,fee_usd,contractual_adj,status
O1,V1,PT-1,03/31/2025,x,D1,30,3,C
O1,V2,PT-1,4/1/2025,x,D2,31,3,NS
O1,V3,PT-1,04/02/2025,x,,0,0,X
""",
    "pms_dolphin/payments": "office_code,posted,source,amount\nO1,03/31/2025,INS,9\nO1,4/1/2025,PAT,8\n",
    "pms_tdo/procedures": """Office,Visit Date,CDT,Gross,Adjustment,Doctor,Status,Chart #,Visit ID
T1,20250303,D2,50,5,x,Seen,4,9
T1,20250304,,0,0,x,No-Show,4,10
""",
    "pms_tdo/payments": "Office,Posted Date,Payer Type,Amount\nT1,20250303,Ins,11\nT1,20250304,Pt,12\n",
    "pms_dentrix/procedures": """ClinicID,ApptID,PatGUID,ProcDate,ProvID,ADACode,Amt,AdjAmt,ApptStatus
C1,1,G1,2025-03-03 00:00:00.000,h,D1,60,6,C
C1,2,G1,2025-03-04 00:00:00.000,d,,0,0,B
""",
    "pms_dentrix/providers": "ProvID,ClinicID,ProvType\nh,C1,Hygienist\nd,C1,Dentist\n",
    "pms_dentrix/payments": "ClinicID,TransDate,TransType,Amount\nC1,2025-03-03 00:00:00.000,InsPayment,13\n",
    "pms_dox/procedures": """Office,Svc Date,Code,Fee,Discount,Provider,Appt Result,Acct #,Appt #
X1,03-09-2025,D1,70,7,h,Done,1,1
X1,3-16-2025,D1,70,7,d,Missed,1,2
""",
    "pms_dox/providers": "Office,Provider,Type\nX1,h,RDH\nX1,d,DDS\n",
    "pms_dox/payments": "Office,Pmt Date,Pmt Source,Amount\nX1,03-09-2025,Insurance,14\n",
    # REG clinical, OT clinical, PTO, unknown earning, unknown job
    "ukg/timecards": """EmployeeNumber,OrgLevel1,JobCode,WorkDate,EarningCode,Hours,HourlyRate
e1,U1,J1,2025-03-03,REG,8,20.50
e1,U1,J1,2025-03-04,OT,2,20.50
e2,U1,J2,2025-03-05,PTO,8,15
e3,U1,J1,2025-03-06,WHAT,1,10
e4,U1,J9,2025-03-06,REG,1,10
""",
    # ISO and US dates, revenue credit, refund, a supply entry, an unknown account, a month without visits
    "sage_intacct/gl_detail": """RECORDNO,ENTRY_DATE,BATCH_TITLE,ACCOUNTNO,ACCOUNTTITLE,LOCATIONID,DEPARTMENTID,TR_TYPE,AMOUNT
1,2025-03-31,"b, quoted
line",4000,Income,E1,CLIN,-1,200
2,03/15/2025,b,4900,Refunds,E1,CLIN,1,7
3,03/31/2025,b,5200,Lab,E1,CLIN,1,40
4,2025-03-31,b,6100,Rent,E1,ADMIN,1,500
5,2025-03-31,b,5300,Supplies,E1,CLIN,1,31
6,2025-03-31,b,9999,What,E1,CLIN,1,3
7,2025-06-30,b,6100,Rent,E1,ADMIN,1,500
8,2025-03-31,b,6000,Wages,E1,ADMIN,1,226
""",
    "inventory/usage": """SiteCode,Period,ItemNumber,Description,VendorCategory,UOM,QtyIssued,UnitCost,QtyOnHand
S1,202503,i1,gloves,GL,EA,10,2.5,4
S1,202503,i2,other,??,EA,1,5,0
""",
    "marketing/channel_performance": """site_slug,month,utm_source,utm_medium,utm_campaign,cost,sessions,form_submits,appts_booked
one,2025-03-01,google,cpc,spring,100.5,10,3,2
one,2025-03-01,unknown,what,odd,1,1,0,0
""",
}

SEEDS = {
    "dim_location": """location_key,location_name,region,specialty,open_date,operatories,pms_system
1,One,North,General,2010-01-01,4,open_dental
2,Two,North,General,2010-01-01,4,dentrix_ascend
3,Three,South,General,2010-01-01,4,sensei
4,Four,South,Orthodontics,2010-01-01,4,dolphin
99,Test,South,General,2010-01-01,1,dox
""",
    "location_crosswalk": """source_system,source_location,location_key
open_dental,1,1
dentrix_ascend,asc-1,2
dentrix_ascend,asc-2,1
sensei,P1,3
dolphin,O1,4
tdo,T1,4
dentrix,C1,3
dox,X1,99
ukg,U1,1
sage_intacct,E1,1
inventory,S1,1
marketing,one,1
windsor_facebook,act_1,1
""",
    "cdt_procedure_map": """cdt_code,description,category,specialty,is_new_patient_code,typical_fee
D1,first,Diagnostic,General,false,10
D2,second,Restorative,General,false,20
NEW,new patient,Diagnostic,General,true,30
""",
    "gl_account_map": """account_no,account_title,category,is_opex,mart_source,notes
4000,Patient income,Revenue,false,pms,
4900,Refunds,Revenue,false,gl,
5200,Lab fees,Lab,true,gl,
5300,Supplies,Lab,true,inventory,
6000,Clinical wages,Payroll,true,ukg,
6010,Office wages,Payroll,true,ukg,
6030,Time off,Payroll,true,ukg,
6100,Rent,Occupancy,true,gl,
6600,Ads,Marketing,true,marketing,
""",
    "ukg_job_map": "job_code,job_title,role,is_clinical\nJ1,Job one,Assistant,true\nJ2,Job two,Front Office,false\n",
    "ukg_earning_map": "earning_code,description,pay_multiplier,is_productive,is_overtime\nREG,Regular,1.0,true,false\n"
                       "OT,Overtime,1.5,true,true\nPTO,Off,1.0,false,false\n",
    "inventory_category_map": "vendor_category,category\nGL,Protection\n",
    "marketing_channel_map": "utm_source,utm_medium,channel,is_paid\ngoogle,cpc,Search,true\n",
}


def write(folder: pathlib.Path) -> tuple[str, str]:
    exports, seeds = folder / "exports", folder / "seeds"
    for name, text in FILES.items():
        path = exports / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        # one export carries a byte order mark
        path.write_text(text, encoding="utf-8-sig" if name.startswith("pms_tdo") else "utf-8")
    seeds.mkdir()
    for name, text in SEEDS.items():
        (seeds / f"{name}.csv").write_text(text)
    return str(exports), str(seeds)
