PO_HEADER = ("POHEADERID,POLINEID,LINENUM,CREATEDBY,CREATIONDATE,FUNDSSTATUS,ITEMDESCRIPTION,LASTUPDATEDBY,"
             "LINESTATUS,LISTPRICE,MATCHINGBASIS,PURCHASEBASIS,SHIPPINGUOMCODE,UNITPRICE,UOMCODE,UNUSEDCOL")


def write_po_csv(path, lines):
    with open(path, "w") as f:
        f.write(PO_HEADER + "\n" + "\n".join(lines) + "\n")
