"""Specs of the four applications: match, cluster, payment, roi."""

from __future__ import annotations

from pairloom.spec import DatasetSpec

# Column names, roles, ranges and response codes of the four input tables.
PROFILE_FIELDS = (
    "userid,workcity,hometown,sex,body,marriage,smoking,drinking,children,wantchildren,house,salary,"
    "height,education,isvalid,occupation,vehicle,age,belief,constellation,bloodtype,family,photo,"
    "corptype,animals,stock,praise"
)
PROFILE_RANGES = ("age, 10, 100", "height, 100, 200", "sex, 0, 1", "marriage, 1, 10")

MATCH = {
    "fields": PROFILE_FIELDS,
    "f_categories": "marriage,salary,education,body,corptype,wantchildren,animals,vehicle,house,smoking,drinking",
    "pending": {"action0": "0", "action1": "0"},
    "positives": {"action0": "1", "action1": "1,2,3", "action2": "8"},
    "negetives": {"action0": "2", "action1": "3,4,5", "action2": "9"},
    "ranges": PROFILE_RANGES,
    "topn": 30,
    "forest": {"nbTrees": 10},
    "female_fields": "marriage,age,height,salary,education,body,family,corptype,wantchildren,animals,praise",
    "male_fields": (
        "marriage,age,height,salary,education,body,family,corptype,wantchildren,animals,smoking,"
        "drinking,vehicle,house"
    ),
}

CLUSTER = {
    "fields": PROFILE_FIELDS,
    "f_categories": (
        "marriage,salary,education,body,corptype,wantchildren,animals,vehicle,house,smoking,drinking,"
        "occupation,belief,constellation,bloodtype,stock"
    ),
    "ranges": PROFILE_RANGES,
    "clusters": "figure,spiritual,life,work,highlight",
    "figure": "age,height,praise,body,bloodtype",
    "spiritual": "animals,belief,constellation,stock",
    "life": "smoking,drinking,house,vehicle",
    "work": "occupation,salary,corptype,education",
    "highlight": "salary,house,vehicle",
}

PAYMENT = {
    "fields": (
        "memberid,iszat,salary,sex,birthday,education,workcity,house,vehicle,marriage,paydate,regtime,"
        "logincount,telcount,telavgtime,lostcount,micropaycount,micropayamount,viewcount,sendleercount,"
        "sendaskcount,sendgiftcount,followcount,praisecount,hnservicecount,viewcount2,receiveleercount,"
        "receiveaskcount,receivegiftcount,followcount2,praisecount2,hnservicecount2"
    ),
    "f_categories": "iszat,salary,sex,education,workcity,house,vehicle,marriage",
    "f_ignore": "workcity,paydate,regtime",
    "f_predictors": (
        "sex,birthday,salary,house,vehicle,marriage,logincount,telavgtime,micropaycount,viewcount,"
        "sendleercount,sendaskcount,sendgiftcount,praisecount,hnservicecount,viewcount2,"
        "receiveleercount,receiveaskcount,receivegiftcount,praisecount2,hnservicecount2"
    ),
    "f_target": "iszat",
    "forest": {"nbTrees": 10},
    "logistic": {"features": 1000, "passes": 10, "rate": 0.0001},
}

ROI = {
    "fields": "channel,year,month,day,income0,income1,income2,income3,total",
    "f_categories": "channel,year,month,day",
    "f_predictors": "income0,income1,income2,income3",
    "target": {"name": "total"},
    "logistic": {"features": 1000, "passes": 10, "rate": 0.0001},
}

MATCH_SPEC = DatasetSpec.from_mapping(MATCH)
CLUSTER_SPEC = DatasetSpec.from_mapping(CLUSTER)
PAYMENT_SPEC = DatasetSpec.from_mapping(
    PAYMENT, types={"birthday": "string", "paydate": "string", "regtime": "string"}
)
ROI_SPEC = DatasetSpec.from_mapping(
    ROI, types={"channel": "string", **{c: "double" for c in ("income0", "income1", "income2", "income3", "total")}}
)
