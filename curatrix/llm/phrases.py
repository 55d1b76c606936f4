"""Seed texts from which the small models start; all are fixed values, plain text by kind and language.

No sentence of them stands in the test tables (case and punctuation apart); tests/llm/test_seeds.py checks it.
"""

#: Error pages and notices.
NOTICES = """
turn them on and reload the page.
JavaScript is disabled. You need to enable JavaScript to run this app.
For full use of this page a newer browser with scripting is required.
Error 404: the requested page could not be found. Reference number.
404 Not Found. 500 Internal Server Error. 502 Bad Gateway. 403 Forbidden.
Please try again in a few minutes.
You do not have permission to view this item.
Please try again later.
Wait a few seconds.
Gateway timeout.
The connection was reset while the document was loading.
Checking your browser before opening the page, one moment.
Return to the home page.
Traceback: upstream said an error occurred
<html><head><title>Error</title></head></html>
{"status": "error", "detail": "something went wrong"}
Bitte aktivieren Sie JavaScript, um den Inhalt anzuzeigen.
bitte einschalten und die Seite neu laden.
Diese Anwendung benötigt eingeschaltete Skripte im Browser.
Fehler 404: Die gewünschte Seite wurde nicht gefunden.
Zugriff verweigert, der Eintrag ist gesperrt.
Der Dienst ist zurzeit nicht erreichbar, bitte in einigen Minuten erneut versuchen.
Ihre Sitzung ist abgelaufen, bitte melden Sie sich erneut an.
Zu viele Anfragen. Bitte warten Sie einen Augenblick.
Beim Laden ist ein Fehler aufgetreten.
Cette application a besoin des scripts dans votre navigateur.
Erreur 404 : la page demandée est introuvable.
Accès refusé, la fiche est protégée.
Le service est indisponible, réessayez dans quelques minutes.
Votre session a expiré, veuillez vous reconnecter.
Trop de requêtes. Veuillez patienter.
Une erreur est survenue pendant le chargement.
Active JavaScript para ver este contenido.
Esta aplicación necesita scripts activados en el navegador.
Error 404: no se encontró la página solicitada.
Acceso denegado, la ficha está protegida.
El servicio no está disponible, inténtelo dentro de unos minutos.
Su sesión ha caducado, inicie sesión de nuevo.
Demasiadas solicitudes. Espere unos segundos.
Se produjo un error al cargar el contenido.
您的浏览器未运行脚本，请开启后刷新页面。
完整使用本页面需要支持脚本的新版浏览器。
请启用 JavaScript 后继续浏览。
没有权限查看该条目，访问被拒绝。
服务暂时不可用，请稍后重试。
请求过于频繁，请等待几秒。
服务器响应超时，工单号。
文档加载过程中连接被重置。
Scripts are blocked in this browser. Allow them and open the page again.
Switch on scripting to use this site. The page cannot be shown without scripts.
An up-to-date browser with script support is needed for this view.
The address you entered does not exist on this server. Check the link.
Nothing was found here. Back to our start page, please.
This content is for members only. Log in first. You have no right to see it.
You have been logged out. Log in once more to go on.
The service is overloaded or down for maintenance. Come back later.
Requests were sent too often. Slow down and try again after a pause.
An internal error occurred and the operation was not completed. Ticket number.
The server did not respond in time. The connection was closed. Request code.
We are verifying that you are human. This may take a moment.
Skripte sind blockiert. Ohne Skripte kann die Seite nicht angezeigt werden, bitte Browser einstellen.
Die Adresse gibt es auf diesem Server nicht. Zurück zur Startseite.
Sie haben keine Berechtigung für diesen Inhalt. Melden Sie sich zuerst an.
Wartungsarbeiten: der Server antwortet nicht. Versuchen Sie es später noch einmal. Vorgangsnummer.
Interner Fehler, der Vorgang wurde abgebrochen.
Les scripts sont bloqués. Sans eux la page ne peut pas s'afficher dans le navigateur.
L'adresse n'existe pas sur ce serveur. Retour à l'accueil.
Vous n'avez pas le droit de voir ce contenu. Connectez-vous d'abord.
Le serveur ne répond pas, maintenance en cours. Essayez plus tard. Numéro de dossier.
Erreur interne, l'opération a été interrompue.
Los scripts están bloqueados. Sin ellos la página no se puede mostrar en el navegador.
La dirección no existe en este servidor. Volver al inicio.
No tiene permiso para ver este contenido. Identifíquese primero.
El servidor no responde, hay mantenimiento. Pruebe más tarde. Número de caso.
Error interno, la operación se interrumpió.
浏览器禁止了脚本，页面内容不能显示，请打开脚本后重试。
需要开启脚本才能使用此网站，请更换新版浏览器。
网址不存在，页面未找到，请返回主页。
没有相关内容，请检查链接，编号。
您无权查看此内容，请先登录。
会话超时，您已退出，请再次登录。
系统繁忙或正在维护，请过一会儿再试。
访问太频繁，请稍等片刻再操作。
内部错误，操作未完成，工单编号，请联系管理员。
服务器没有响应，连接已断开，请求代码。
正在确认您是真人，请稍等，检查完成后自动跳转。
本站的应用要求在浏览器里打开脚本，代码。
程序需要浏览器的脚本功能才能运行，编号。
""".strip().split("\n")

#: Real questions about errors, browsers and access; they are prose.
ASKED = """
Why does the browser of this machine show an error page after the update, and when did it first appear?
Which entry of the log says that access to the part was denied or that a script was blocked?
What should be done when the display reports error 500 or that a file could not be found?
How long does the server of the line take to answer before the session expires?
Warum zeigt der Browser des Geräts nach der Aktualisierung einen Fehler, und seit wann?
Welcher Eintrag im Protokoll meldet, dass der Zugriff verweigert oder ein Skript blockiert wurde?
Was ist zu tun, wenn die Anzeige Fehler 404 meldet oder die Seite nicht lädt?
Pourquoi le navigateur de la machine affiche-t-il une erreur après la mise à jour ?
Quelle ligne du journal signale un accès refusé ou un script bloqué ?
¿Por qué muestra el navegador del equipo un error después de la actualización?
¿Qué línea del registro avisa de un acceso denegado o de un script bloqueado?
为什么这台设备的浏览器在更新之后显示错误页面？
日志里哪一条记录提示访问被拒绝或者脚本被禁止？
显示屏报告错误代码或者页面无法加载时应该怎么处理？
""".strip().split("\n")

#: Filler and unfilled forms.
FILLER = """
TBD: write the question for this item here
TODO: add the question text
Sample question text, to be replaced before release
This is dummy text used to show the layout of the card.
Intro for section, final copy to follow
Lead text for the block;
Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
Lorvem ipsar dolen sitam consetra dipisan elit sed dovar tempis incidar ut laborent magnis veniar quistro nostrem.
xxxxx xxxxx
Hier steht später der Fragetext, bitte ersetzen
Noch offen: Frage formulieren
Platzhalter für die Frage
(leere Vorlage, Fassung)
Ici viendra le texte de la question, à remplacer
(modèle vide, version)
Este es un texto de relleno para la ficha.
Aquí irá el texto de la pregunta, pendiente de cambiar
Por completar: pregunta
(plantilla vacía, versión)
待补充：问题内容
此处为示例问题文字，发布前请替换
这是一段用于展示卡片排版的占位文字。
版块的导语，正式文字稍后提供
Your question here
Replace this text. Replace this text. Replace this text.
Text text text. Question question question.
Example only, wording to be supplied later
Placeholder line, not for publication
(blank form, draft)
foo bar baz foo bar
qwerty qwerty asdfgh
aaa bbb ccc
Hier Text einfügen. Mustertext, wird noch ersetzt
(leeres Formular, Entwurf)
Insérer le texte ici. Texte d'exemple, à changer plus tard
(formulaire vide, brouillon)
Insertar el texto aquí. Texto de ejemplo, se cambiará después
(formulario vacío, borrador)
请在此填写题目。请输入内容。
此处填写问题文字，样例待替换。
占位内容，正式文字以后补充。
（空白表格，草稿）
样例样例样例 题目题目题目 内容内容内容
在这里填写题目（序号）。请把问题写在这里。
测试条目，测试用，测试一下，再测试
（模板为空，编号）
This is a test entry. Testing, testing. Test question, test answer, tests
""".strip().split("\n")

#: Names that templates put into slots.
SLOT_NAMES = "name value product model model_name part target entity topic metric attr term node relation source unit question question_text item title user date text 实体 数值 产品 名称 问题 指标".split()
#: Slots as they are written, from the marks (N stands for the name).
SLOTS = [m.replace("N", n.upper() if i % 3 == 0 else n) for m in ("{{N}}", "{{ N }}", "${N}", "#{N}", "{N}", "<N>", "<%= N %>", "@@N@@", "%(N)s", "%N%", "[[N]]", "[N]", "__N__", "XX_N_XX", "{{N|default}}", "{N!r}", "{N_1}", "____", "%s", "{}", "{0}", "undefined", "NaN", "null", "……（    ）", "(insert N)", "(N)", "（请填写N）") for i, n in enumerate(SLOT_NAMES)]

#: Exact grammar of slots; a window that the model finds must hold one of these.
SLOT_GRAMMAR = r"\{\{[^{}]{0,60}\}\}|[$#]\{[^{}]{0,60}\}|<%.{0,60}?%>|@@\w+@@|%\(\w+\)[a-z]|%[sd](?!\w)|%[A-Za-z_]{3,}%|\[\[[^\[\]]{0,60}\]\]|\{[^\W\d][\w!.|:]*\}|\{\d?\}|<[^\W\d]\w*>|\[[^\W\d]\w*\]|__+[A-Za-z]\w*?__|XX_\w+?_XX|_{3,}|(?<![A-Za-z])(?:undefined|NaN|null)(?![A-Za-z])|[（(]\s{2,}[）)]|[(（](?:insert|enter|add|einfügen|insérer|insertar|插入|填写|填入|输入|请填写|请输入|此处填写)[^()（）]{0,30}[)）]"

#: Refusals.
REFUSALS = """
Sorry, I cannot provide an answer here.
As an AI assistant, I am not able to answer questions on this subject.
I must decline to discuss this.
I am unable to comply with that request. I won't answer this. I cannot assist with that.
As an AI language model I can't provide that information. I regret that I cannot answer.
Es tut mir leid, aber ich kann diese Frage nicht beantworten.
Als KI-Assistent darf ich dazu keine Auskunft geben. Kann ich Ihnen sonst helfen?
Leider fehlen mir die nötigen Angaben für eine Antwort. Darüber kann ich nicht sprechen.
Entschuldigung, ich muss diese Anfrage ablehnen. Ich bin nicht in der Lage, das zu beantworten.
Je regrette, je dois refuser de parler de ce sujet.
Consulte a un especialista.
Como asistente de IA, no estoy en condiciones de dar esa información.
Lamentablemente me faltan datos para contestar. Debo rechazar hablar de este tema.
Disculpe, no me es posible ayudarle con esta petición.
抱歉，我不能就这个问题提供答复。
作为人工智能助手，我无法回答关于它的这个问题。
我必须拒绝讨论这个话题。 我不便回答这个问题。
I can't assist with this. I have to refuse. That is not something I may discuss.
There is not enough information here for me to reply. I lack the details for an answer.
Sorry, this is a question I can't answer. Ask an expert instead. Let us choose something else to talk about.
Can I help you with anything else? I apologise for that.
As an assistant I must not give an answer to it.
Leider kann ich dazu nichts sagen. Wenden Sie sich an einen Experten. Reden wir über etwas anderes.
Mir fehlen die Informationen, um das zu beantworten. Haben Sie eine andere Frage?
Désolé, je ne peux pas donner cette réponse. Adressez-vous à un expert. Parlons d'autre chose.
Je n'ai pas assez d'informations pour répondre. Avez-vous une autre question ?
En tant qu'IA, je ne dois pas répondre à cette demande.
Perdone, no puedo dar esa respuesta. Diríjase a un experto. Hablemos de otra cosa.
No tengo suficiente información para responder. ¿Tiene otra pregunta?
Como IA no debo contestar a esa solicitud.
抱歉，我无法为您解答。请向专家咨询。我们谈谈别的吧。
不好意思，这个忙我帮不了，换一个问题吧。
信息不够，我不能给出答复。您还有别的问题吗？
作为智能助手，我不能就此作答。很抱歉，恕我不能讨论。
""".strip().split("\n")

#: Ordinary sentences by language; they start the language models where a table has few labels.
SENTENCES = {
    "en": "The engineers measured the temperature after several hours and wrote it down. How does the motor influence the noise of the machine? When the pump was replaced, the value fell below the limit. Which part of this product should be checked before it is used again? According to the note, they kept the panel at a lower brightness, because it would not last.",
    "de": "Die Bediener prüfen vor dem Versuch, ob der Wert unter dem Grenzwert bleibt, und tragen ihn ein. Welche Schritte senken den Verbrauch des Geräts? Nach einigen Stunden wurde die Temperatur im Werk gemessen, und sie bleibt gleich. Warum wurde das Gehäuse für die neue Fassung geändert? Laut Notiz zeigte sich, dass der Motor nicht geeignet ist.",
    "fr": "Les opérateurs vérifient avant l'essai que la valeur reste sous la limite et la notent. Comment le moteur agit-il sur le bruit de la machine ? Après plusieurs heures, l'équipe a relevé une température plus basse, mais elle ne change pas. Pourquoi la pompe a-t-elle été ajoutée dans cette version ? Selon la note, le filtre a été revu pour le produit, car il vieillit.",
    "es": "Los operarios revisan antes del ensayo que el valor siga por debajo del límite y lo anotan. ¿Cómo influye el motor en el ruido de la máquina? Tras varias horas, el equipo midió una temperatura más baja, pero no cambia. ¿Por qué se añadió la bomba en esta versión? Según la nota, el filtro se cambió en el producto porque envejece.",
    "zh": "操作员在试验开始之前检查温度，并把结果登记下来。怎样才能降低这台设备的噪声？工程师在几个小时后测得的数值低于上限。为什么这个版本重新设计了部件？根据记录，它可以承受更高的温度，同时保护电源。",
}
