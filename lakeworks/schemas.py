"""Table schemas, column names of the partners and accepted values."""

from __future__ import annotations

from pyspark.sql import types as T


def schema(**columns: T.DataType | str) -> T.StructType:
    kinds = {
        "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
        "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(),
        "boolean": T.BooleanType(),
    }
    return T.StructType(
        [T.StructField(n, kinds[k] if isinstance(k, str) else k) for n, k in columns.items()]
    )


# Column names, label texts and value sets that outside files carry.

SALES = schema(
    order_id="string", customer_id="string", product_id="string", quantity="int",
    unit_price="double", total_amount="double", order_date="timestamp", payment_method="string",
    shipping_city="string", shipping_state="string", status="string", partner_source="string",
)

CUSTOMERS = schema(
    customer_id="string", customer_name="string", email="string", phone="string", city="string",
    state="string", registration_date="timestamp", segment="string",
)

PRODUCTS = schema(
    product_id="string", product_name="string", category="string", subcategory="string",
    unit_price="double", weight_kg="double", is_active="boolean",
)

SUBCATEGORY = schema(subcategory_id="string", subcategory_name="string")
CATEGORY = schema(
    category_id="string", category_name="string", subcategories=T.ArrayType(SUBCATEGORY)
)
CATEGORIES = schema(categorias=T.ArrayType(CATEGORY), generated_at="string")

# Portuguese column names of the legacy partner
LEGACY_NAMES = {
    "cod_pedido": "order_id",
    "cod_cliente": "customer_id",
    "cod_produto": "product_id",
    "qtd": "quantity",
    "preco_unit": "unit_price",
    "valor_total": "total_amount",
    "data_pedido": "order_date",
    "forma_pagamento": "payment_method",
    "cidade_entrega": "shipping_city",
    "uf_entrega": "shipping_state",
    "situacao": "status",
    "origem": "partner_source",
}

STATUSES = ("pending", "shipped", "delivered", "cancelled")
PAYMENT_METHODS = ("credit_card", "debit_card", "pix", "boleto")
LEGACY_DATE_FORMATS = ("dd/MM/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")
NO_NAME = "Cliente Não Cadastrado"
NO_SEGMENT = "Sem Segmento"
NO_CATEGORY = "Sem Categoria"
UNKNOWN_CUSTOMER = "UNKNOWN_CUSTOMER"
UNKNOWN_PRODUCT = "UNKNOWN_PRODUCT"

# end of fixed values

LEGACY = T.StructType([T.StructField(n, T.StringType()) for n in LEGACY_NAMES])

# sales as an interface sends them: dates still text
SALE_ROW = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "order_date" else f.dataType) for f in SALES]
)
PAGE = schema(
    api_version="string", exported_at="string", page="long", total_pages="long",
    data=T.ArrayType(SALE_ROW),
)

SILVER = schema(
    order_id="string", customer_id="string", product_id="string", quantity="long",
    unit_price="double", total_amount="double", order_date="date", payment_method="string",
    shipping_city="string", shipping_state="string", status="string", _source="string",
)

CHECK_RESULTS = schema(
    check_name="string", passed="boolean", metric_value="double", threshold="double",
    details=T.MapType(T.StringType(), T.StringType()), severity="string",
)
