"""Files shipped with the package; read through the importer, as it may sit in a zip."""

import pkgutil

INVOICE_ITEM_SCHEMA = pkgutil.get_data(__name__, "invoice_item.avsc").decode()
